"""Readers, generated series, sample data and table layout."""
