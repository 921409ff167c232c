"""Plans over the given tables: derived inputs, the query catalog, multi-table ingest."""
