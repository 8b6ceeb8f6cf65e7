"""Jobs composed of operators, and the checked queries with their SQL."""
