"""DataFrame -> DataFrame operators: enrichment, quality, features, models."""
