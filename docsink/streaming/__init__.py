"""Streams of changes."""
