"""Readers, the dataset registry, typed chart tables and sinks."""
