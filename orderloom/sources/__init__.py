"""Readers: landed pages, stored tables and the mapping of the test tables."""
