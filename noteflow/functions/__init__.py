"""Column functions."""
