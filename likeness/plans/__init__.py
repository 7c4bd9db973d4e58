"""Registered queries (``QUERIES``) and their DuckDB oracle text (``ORACLE``)."""
