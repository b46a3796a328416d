"""DataFrame operators, grouped by family (shape, joins, agg, kv, windows, ordering, partition, docs, jobs)."""
