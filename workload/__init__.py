"""Queries over the test tables, with the equivalent SQL."""
