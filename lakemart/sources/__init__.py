"""Raw sources, bronze ingestion and table hand-off."""
