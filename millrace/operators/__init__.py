"""Relational operators: quality gate, splits, generators, selection, datasets, metrics."""
