"""Continuous forms of the loads."""
