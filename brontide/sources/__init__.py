"""Market-data sources."""
