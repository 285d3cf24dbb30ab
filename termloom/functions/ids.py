"""Identifier formatting."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def external_id(number: Column) -> Column:
    """``doc_`` and the number padded to eight digits; longer numbers are kept whole."""
    return F.format_string("doc_%08d", number)
