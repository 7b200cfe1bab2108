"""Change-data operators for PySpark: ingest, normalise, enrich, diff, version, serve and monitor."""
