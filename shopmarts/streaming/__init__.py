"""Structured Streaming jobs (continuous evaluation of arriving verdicts)."""
