"""Scans, contract-checked reads and sinks."""
