"""Registered queries, their DuckDB oracle and the comparison tool."""
