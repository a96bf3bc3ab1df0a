"""Datasets and compositions of operators."""
