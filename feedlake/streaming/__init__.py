"""Structured Streaming queries that keep bronze and silver up to date."""
