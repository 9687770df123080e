"""Column expressions over records."""
