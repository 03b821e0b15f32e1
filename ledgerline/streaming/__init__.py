"""Structured Streaming form of the pairing (incremental, with carried state)."""
