"""Storage: declared schemas, dated tables, landed pages."""
