"""Whole jobs: ingestion of a feed, splitting a feed, and the contracts they run on."""
