"""Queries over live input, and what they remember."""
