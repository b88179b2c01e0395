"""Streaming: the after-insert trigger as a Structured Streaming micro-batch."""
