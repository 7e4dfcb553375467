"""Column functions and frames."""
