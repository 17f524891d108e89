"""Column expressions: they take columns (or column names) and return columns."""
