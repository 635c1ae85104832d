"""The models: staging, star schema, market metrics, reports, ingestion."""
