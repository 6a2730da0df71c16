"""Getting geometry tables in and out: ingest, profile, export, clustered tables."""
