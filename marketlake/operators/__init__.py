"""DataFrame operators: de-duplication, joins, shaping, set operations,
aggregation helpers, skew-safe ordering, load planning and incremental loads."""
