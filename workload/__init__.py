"""Registered queries over the given tables, each with the DuckDB statement it must agree with."""
