from bankspark.sources.tables import TABLES, load_table  # noqa: F401
