"""Column expressions and shared distributed building blocks."""
