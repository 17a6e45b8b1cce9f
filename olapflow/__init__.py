"""Dimensional, event-time and spatial analytics as plain DataFrame functions."""
