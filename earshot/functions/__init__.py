"""Column expressions and the numeric helper that runs inside tasks."""
