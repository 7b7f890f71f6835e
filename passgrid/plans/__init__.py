"""The two jobs over batch input."""
