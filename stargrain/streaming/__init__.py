from stargrain.streaming.ingest import ingest_csv, ingest_feeds, ingest_files, profile_csv, schema_drift, stored_schema  # noqa: F401
