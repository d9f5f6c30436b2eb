"""Generic table operators: row rules, joins, aggregations, windows, sets,
sinks and data-quality checks."""
