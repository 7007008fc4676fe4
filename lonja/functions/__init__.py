"""Column expressions for cleaning dirty text."""
