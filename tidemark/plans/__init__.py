"""Named queries over the given tables, their DuckDB oracles, config-driven ingest."""
