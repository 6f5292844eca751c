"""Training-data operators: mixing, filters, classifiers, deduplication, counting."""
