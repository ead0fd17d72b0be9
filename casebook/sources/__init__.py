from casebook.sources.tables import table, TABLES  # noqa: F401
