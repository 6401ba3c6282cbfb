"""Readers, schemas and record sinks."""
