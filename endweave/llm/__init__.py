"""Training-data operators: dedup, mixing, language ID, chat formatting, sharding,
fingerprints, license scans, toxicity, near-duplicate joins and packing."""
