"""Market-data operators."""
