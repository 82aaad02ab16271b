"""The registered queries: the jobs of ``tiermill`` over the given tables, and their SQL twins."""
