"""Structured Streaming jobs over transaction messages."""
