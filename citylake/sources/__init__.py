"""Readers, generated row sets and sinks."""
