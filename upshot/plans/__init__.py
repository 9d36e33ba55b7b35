"""Composed plans: registered queries over the driver tables and the report tables."""
