"""Readers, parsers of nested text, record validation and writers."""
