"""DataFrame operators: ranks, joins, filters, metrics, profiles, tables."""
