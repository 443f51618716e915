"""Table operators: deduplication, keys, history, quantiles, lookups, checks and profiles."""
