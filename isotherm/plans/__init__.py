"""Driver plans: the driver tables re-shaped as monthly observation sources, the
query registry used by ``__spark_entry__`` and the DuckDB oracle SQL."""
