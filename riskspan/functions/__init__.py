"""Column-level functions: each returns a Column or a DataFrame built from
built-in Spark expressions only (no Python UDFs)."""
