"""Training-data operators: dedup, sharding, toxicity, search, tokenisation, quality, packing, language ID."""
