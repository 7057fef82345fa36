"""Training-data operators: deduplication, quality, private data, tokenising, packing, sharding, pages."""
