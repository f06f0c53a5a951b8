"""Column -> Column functions built from native Spark expressions (no Python UDFs)."""
