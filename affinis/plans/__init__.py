"""Compositions of operators."""
