"""Fixture views, registered queries, DuckDB twins and the comparison harness."""
