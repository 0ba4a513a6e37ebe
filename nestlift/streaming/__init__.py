"""Structured Streaming front end: landed files -> bronze -> silver per micro-batch."""
