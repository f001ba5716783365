"""Composed workflows and the registered query catalogue."""
