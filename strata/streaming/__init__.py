from strata.streaming.ingest import incremental_ingest  # noqa: F401
