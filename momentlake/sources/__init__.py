"""Readers and writers: raw JSON documents and logs to and from tables."""
