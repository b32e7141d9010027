"""tidemark: checking and counting events in an append-only log, on Spark.

Modules:
    sources    given tables, derived log relations, log scans, connector registry
    functions  column functions (frames, JSON, ISO-8601 text, intervals)
    operators  delivery dedup, event-time windows, contracts, monitoring metrics
    streaming  Structured Streaming forms of the same operators
    plans      named queries, their DuckDB oracles, config-driven ingest
"""

__version__ = "0.1.0"
