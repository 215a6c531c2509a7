"""Structured Streaming over the landing zone."""
