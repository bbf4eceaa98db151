"""Scans, sinks, configuration documents and the test-table adapter."""
