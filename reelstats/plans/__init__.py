"""Named queries: a Spark builder and a DuckDB oracle per key (see registry.load_all)."""
