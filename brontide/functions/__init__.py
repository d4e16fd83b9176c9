"""Market-data functions."""
