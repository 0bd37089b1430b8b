"""Named queries over the test tables and their DuckDB oracle text."""
