"""Whole jobs composed of operators: bronze->silver fan-out, upsert-all, reports, fixtures."""
