"""DataFrame operators: windows, joins, aggregates, upserts, reconciliation, incremental planning."""
