"""Column functions: expressions only, no data movement."""
