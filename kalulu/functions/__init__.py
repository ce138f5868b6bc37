"""Column-level helpers; all are built-in Spark expressions (no Python UDFs)."""
