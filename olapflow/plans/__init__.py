"""Dimensional-model plans built from the operators."""
