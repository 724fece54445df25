"""Table operators: columns, rows, joins, splits, metrics, moments, encoders, ridge."""
