"""Scans, sinks, schemas and the test-table adapters."""
