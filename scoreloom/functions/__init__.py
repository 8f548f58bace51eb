"""Column expressions used by the operators and panel tables."""
