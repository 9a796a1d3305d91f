"""Tap: show the key and value of every record, no filter.

Inventory: K4.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tap_text(key: str = "key", value: str = "value") -> Column:
    """``key:<key>value:<value>``; a missing key or value prints as ``null``
    (string concatenation on the JVM renders null that way)."""
    return F.concat(F.lit("key:"), F.coalesce(F.col(key), F.lit("null")),
                    F.lit("value:"), F.coalesce(F.col(value), F.lit("null")))


def tap_records(records: DataFrame, keep=("partition", "offset")) -> DataFrame:
    """One text line per record (works on tables and streams)."""
    return records.select(*keep, tap_text().alias("line"))
