"""Streaming jobs and the keyed tables they maintain."""
