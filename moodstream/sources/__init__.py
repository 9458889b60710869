"""Readers for files, topics and serving tables, and the message codec."""
