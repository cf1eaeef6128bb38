"""Scans, table storage and sinks."""
