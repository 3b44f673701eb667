"""Operators on frames and tables."""
