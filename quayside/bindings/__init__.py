"""The operators bound to the driver's tables, each with the same query as plain SQL."""
