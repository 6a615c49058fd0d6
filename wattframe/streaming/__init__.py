"""Structured Streaming forms of the polling feeds."""
