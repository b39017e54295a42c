"""Live transactions: message format, sources, ingest."""
