"""End-to-end plans (ingestion, training, monitoring) and the query catalog."""
