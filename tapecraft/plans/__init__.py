"""Composite models (gold layer) and the query/oracle registry."""
