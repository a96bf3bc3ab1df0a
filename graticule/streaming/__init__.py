"""Resampling of unbounded input."""
