"""Column functions. All are native expressions; none raises on odd input, so evaluation order never matters."""
