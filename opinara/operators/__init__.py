"""Operators of the opinara engine."""
