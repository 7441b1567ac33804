"""DataFrame -> DataFrame steps of an ingestion run."""
