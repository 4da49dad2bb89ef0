"""Training-data operators: filtering, scoring, deduplication, packing and sharding of documents."""
