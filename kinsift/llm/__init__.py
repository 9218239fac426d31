"""Training-data operators: quality, dedup, sharding, decontamination, tokenising, archives."""
