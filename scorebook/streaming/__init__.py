"""New-file ingest as a stream."""
