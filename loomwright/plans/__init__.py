"""The jobs: ingest, validation, models, sweep."""
