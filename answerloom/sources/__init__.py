"""Readers, sinks and the shared staging area."""
