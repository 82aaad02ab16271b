"""Column expressions and row predicates, all built on Spark's own functions."""
