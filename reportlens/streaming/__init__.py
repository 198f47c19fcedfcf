"""Continuous arrival of extract files."""
