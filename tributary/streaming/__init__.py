"""Structured Streaming over the landing area."""
