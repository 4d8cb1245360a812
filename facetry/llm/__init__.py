"""Training-data operators: tokenising, packing, filtering, fingerprints, search and extraction."""
