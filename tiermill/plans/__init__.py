"""The jobs: bronze, dimensions, silver, gold, star queries and the full refresh."""
