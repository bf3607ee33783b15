"""Operators from tables to a table."""
