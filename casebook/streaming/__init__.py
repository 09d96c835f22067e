"""Incremental ingestion of newly landed pages."""
