"""Functions of the opinara engine."""
