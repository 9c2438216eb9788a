"""Whole jobs made of the operators, and the catalogue of queries."""
