"""Incremental forms of operators that have a natural streaming shape."""
