"""Person records: generation, encoding for a stream, ingest from one."""
