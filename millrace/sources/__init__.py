"""Readers, writers and file layout."""
