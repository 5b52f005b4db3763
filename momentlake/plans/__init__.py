"""Jobs composed from several operators."""
