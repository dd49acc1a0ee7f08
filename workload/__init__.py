"""Queries over the sample tables, with their SQL twins."""
