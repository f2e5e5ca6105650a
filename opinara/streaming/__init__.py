"""Streaming of the opinara engine."""
