"""DataFrame operators: mentions, contexts, joins, ranking and upserts."""
