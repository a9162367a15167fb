"""Compositions of the operators that a user calls."""
