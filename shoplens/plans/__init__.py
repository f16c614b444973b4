"""Chains of operators: layered runs over a storage root, named queries, skew helpers."""
