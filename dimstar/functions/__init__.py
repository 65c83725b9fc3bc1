"""Fixed values and column expressions (calendar, row hash)."""
