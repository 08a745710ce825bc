"""Structured Streaming over landed product events."""
