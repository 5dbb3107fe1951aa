"""Scans of lexical and sensor files, and table sinks."""
