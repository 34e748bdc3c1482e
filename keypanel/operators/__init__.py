"""DataFrame operators: columns, joins, aggregation, ranking, quality, profiles."""
