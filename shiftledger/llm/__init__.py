"""Training-data operators: language, toxicity, duplicates, mixing, packing, sharding, token files."""
