"""Errors raised while a plan is being built."""


class QueryError(ValueError):
    """The request cannot be turned into a plan."""
