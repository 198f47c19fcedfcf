"""Composed plans: the full run, the serving queries and the sample-table mapping."""
