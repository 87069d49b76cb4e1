"""Relational, window, interval and sequence operators."""
