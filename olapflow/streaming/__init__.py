"""Operators for unbounded input."""
