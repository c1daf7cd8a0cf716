"""Training-data operators: dedup, decontamination, quality, mixing, filters."""
