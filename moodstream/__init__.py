"""Sentiment analytics over short messages, on Spark tables and Spark streams."""
