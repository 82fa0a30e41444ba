"""The speed layer on Structured Streaming."""
