"""Readers, sinks, table schemas and the input views."""
