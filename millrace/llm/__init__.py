"""Training-data operators: search, near-duplicates, line and substring dedup, packing, filters, mixing, scoring."""
