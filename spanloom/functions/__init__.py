"""Column expressions and small helpers for work inside tasks."""
