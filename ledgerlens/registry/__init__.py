"""Queries over the driver's tables, and the SQL each of them is checked against."""
