"""Readers, landing tables and table sinks."""
