"""Structured Streaming over append-only event files."""
