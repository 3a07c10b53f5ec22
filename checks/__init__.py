"""Queries over the driver's tables, and the same questions as plain SQL."""
