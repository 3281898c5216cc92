"""DataFrame -> DataFrame operators: enrichment, reports, quality checks."""
