"""Market-data plans."""
