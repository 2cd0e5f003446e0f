"""Readers, windows and sinks."""
