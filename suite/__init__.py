"""Check suite: every operator as a query over the given tables, with its DuckDB counterpart."""
