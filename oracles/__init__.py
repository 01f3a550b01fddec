"""SQL counterparts of the registered queries, for DuckDB over the raw tables."""
