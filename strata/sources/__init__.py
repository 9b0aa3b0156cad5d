from strata.sources.tables import TABLES, table  # noqa: F401
