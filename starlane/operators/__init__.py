"""DataFrame operators: gates, integrity checks, enrichment, derived columns."""
