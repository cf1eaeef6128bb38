"""Adapters that derive the inputs from the driver tables, queries over them, and their SQL."""
