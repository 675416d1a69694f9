"""DataFrame -> DataFrame operators (filters, joins, ordering, dedupe)."""
