"""Structured Streaming form of the incremental daily load."""
