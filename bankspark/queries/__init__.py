"""Registry of named queries: a Spark callable and, where SQL can express it, DuckDB oracle text."""

from bankspark.queries.registry import oracle_sql, queries  # noqa: F401
