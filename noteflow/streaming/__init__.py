"""Structured Streaming over append-only manifests."""
