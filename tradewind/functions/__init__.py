"""Column expressions: times, text and JSON."""
