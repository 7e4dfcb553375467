"""Indicator families, feature quality, correlation and ranking."""
