"""Column expressions, and the functions that run inside tasks."""
