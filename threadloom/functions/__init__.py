"""Column expressions without state: text, time, vectors, JSON answers."""
