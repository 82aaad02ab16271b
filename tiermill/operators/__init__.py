"""Relational building blocks: keep-newest, numbering, lookups, histories, quality checks."""
