"""Scans, schema checks and sinks."""
