"""termloom: keyword search and index analytics over document tables, as Spark jobs."""

from termloom.functions.text import DEFAULT_OPTIONS, TokenOptions

__all__ = ["DEFAULT_OPTIONS", "TokenOptions"]
