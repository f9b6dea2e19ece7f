"""Registered queries: one per operator, over views of the given tables."""
