"""Column expressions and distributed quantile / rank helpers."""
