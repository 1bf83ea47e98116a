"""Whole plans, and the named queries over the given tables."""
