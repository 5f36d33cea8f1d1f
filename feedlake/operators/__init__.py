"""Table-to-table building blocks: dedupe, merge, joins, top-k, search."""
