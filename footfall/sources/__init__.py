"""Raw tables: their schemas, CSV ingest, and lookup by name."""
