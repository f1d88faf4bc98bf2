"""Whole plans: the daily load, the lazily written warehouse, the query registry."""
