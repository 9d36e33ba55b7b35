"""Column expressions, distribution helpers and distributed quantiles."""
