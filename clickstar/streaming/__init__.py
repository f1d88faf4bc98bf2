"""Structured Streaming versions of flattening, volume, sessions and upsert."""
