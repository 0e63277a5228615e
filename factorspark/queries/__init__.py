"""Registered jobs over the test tables, each with its DuckDB oracle SQL."""
