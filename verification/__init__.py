"""Checks of the package on the given tables: bronze adapters, registered queries, expected SQL."""
