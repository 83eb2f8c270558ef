"""Scans and sinks: raw files, driver tables, table writes."""
