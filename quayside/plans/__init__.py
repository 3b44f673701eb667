"""Whole jobs: loads with their log, and the turnover reports."""
