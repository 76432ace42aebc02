"""Column expressions, SQL-text builders and the exact distributed quantiles."""
