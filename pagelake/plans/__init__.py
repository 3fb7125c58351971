"""Registered queries, each with the same in SQL."""
