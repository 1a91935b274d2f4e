"""Registered queries over the given tables, and an independent SQL statement for each."""
