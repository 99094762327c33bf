"""Training-data operators: sharding, token counts, fingerprints, BPE, toxicity, near and exact
dedup, packing, HTML extraction and record files. Nothing outside this subpackage imports it."""
