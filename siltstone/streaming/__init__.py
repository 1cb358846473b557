"""Structured Streaming forms. All queries drain what is available and stop."""
