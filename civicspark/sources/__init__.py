"""Scans, incremental extracts and cursor state."""
