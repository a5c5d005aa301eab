"""Column functions. Each takes columns and returns a column; nothing here touches data."""
