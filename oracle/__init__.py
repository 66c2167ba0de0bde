"""Independent SQL statements of every query, for DuckDB."""

from oracle.sql import statements

__all__ = ["statements"]
