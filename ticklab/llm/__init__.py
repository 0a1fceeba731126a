"""Training-data operators (corpus cleaning, deduplication, classification, tokenising, packing)."""
