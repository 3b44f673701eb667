"""Scans: listings, archives, delimited text, Parquet, text objects, tables."""
