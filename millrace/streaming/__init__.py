"""Structured Streaming forms of the booking and lead flows."""
