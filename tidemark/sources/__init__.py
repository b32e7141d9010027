"""Sources: the given tables, log relations derived from them, scans, connectors."""
