"""Column-level rules: keys, types, classification."""
