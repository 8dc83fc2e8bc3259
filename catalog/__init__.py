"""Registered queries over the sample data, and the same in SQL."""
