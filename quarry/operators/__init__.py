"""Relational operators on DataFrames: filters, joins, aggregates, ranks,
nearest-place join, lenient validation and data-quality checks."""
