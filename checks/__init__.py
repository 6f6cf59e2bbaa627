"""Checked queries: inputs derived from the driver tables, queries and oracle SQL."""
