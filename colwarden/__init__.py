"""Schema contracts over bulk tabular exports, as Spark DataFrame operations."""
