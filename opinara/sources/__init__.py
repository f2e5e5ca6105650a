"""Sources of the opinara engine."""
