"""Training-data operators: dedup, mixing, WARC, search, PII, toxicity, sharding, packing, secrets."""
