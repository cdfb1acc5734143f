"""Training-data operators: deduplication, quality, extraction, packing."""
