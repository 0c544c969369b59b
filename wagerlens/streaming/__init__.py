"""Structured Streaming forms of the hourly loads and live signals."""
