"""The registered queries and, for each, a DuckDB query that must give the same rows."""
