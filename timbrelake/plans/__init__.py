"""Registered queries on the given tables, and the end-to-end jobs."""
