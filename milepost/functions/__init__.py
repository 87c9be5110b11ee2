"""Column expressions, labels and exact grouped quantiles."""
