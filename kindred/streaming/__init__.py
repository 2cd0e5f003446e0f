"""Incremental steps on files as they arrive."""
