"""Captures, archives, topics, and packets derived from the test tables."""
