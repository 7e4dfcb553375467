"""Whole-run plans: the feature table, and selection over it."""
