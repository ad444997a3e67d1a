"""Change-feed ingest on Structured Streaming."""
