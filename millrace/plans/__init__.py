"""Named queries over the driver's tables, each with its DuckDB counterpart where SQL can express it."""
