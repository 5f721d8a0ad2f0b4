"""DataFrame operators: columns, reshaping, quality gates, joins, geometry."""
