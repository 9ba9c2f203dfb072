"""DataFrame operators: quality, cleaning, keys, joins, merges, reports."""
