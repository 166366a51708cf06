"""Reading, partitioning, writing and loading tables."""
