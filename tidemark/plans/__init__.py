"""Queries over the bundled test bed, with their DuckDB twins."""
