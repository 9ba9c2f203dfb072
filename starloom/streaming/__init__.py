"""Incremental ingestion: high-water marks and load-only-what-is-new."""
