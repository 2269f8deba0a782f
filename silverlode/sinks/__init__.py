"""Stored tables and their write policies."""

from silverlode.sinks.tables import LoadReport, TableStore

__all__ = ["LoadReport", "TableStore"]
