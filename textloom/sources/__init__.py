"""Readers and writers for landed corpus files."""
