"""Indicators over an unbounded stream of bars."""
