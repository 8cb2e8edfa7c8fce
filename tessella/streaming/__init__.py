"""Arriving files, annotation saves and logs as streams."""
