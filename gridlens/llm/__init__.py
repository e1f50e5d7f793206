"""Training-data operators: deduplication, filtering, scoring, tokenisation and sharding."""
