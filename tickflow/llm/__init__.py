"""Training-data operators: extraction, language, deduplication, quality, privacy, mixing, archives."""
