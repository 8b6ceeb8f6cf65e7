"""Files, tables and the views derived from given tables."""
