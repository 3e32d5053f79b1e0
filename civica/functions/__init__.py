"""Column expressions: name cleaning, number parsing, safe statistics."""
