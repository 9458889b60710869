"""Structured Streaming jobs that keep the serving tables up to date."""
