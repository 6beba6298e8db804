"""Training-data operators: scoring, tokenising, deduplication, mixing and filtering of text tables."""
