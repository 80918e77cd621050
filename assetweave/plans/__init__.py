"""Projections of the test tables and the catalogue of queries."""
