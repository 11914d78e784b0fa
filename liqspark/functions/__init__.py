"""Column functions: surrogate keys, classifications, buckets, ratios and statistics."""
