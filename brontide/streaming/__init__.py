"""Market-data streaming."""
