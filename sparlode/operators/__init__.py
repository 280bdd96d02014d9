"""Filters, aggregates, facets, joins and windows over nested columns."""
