"""Record -> fields: clean, split, width guard, positional -> named projection.

Inventory: P1/P2 (value, drop null/empty), P6 (positional -> named), P7 (width guard).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..conf import WIDE_FIELD_SEP, WIDE_LAYOUT, WIDE_MIN_WIDTH
from ..functions.split import split_csv, split_literal
from ..functions._util import as_col
from ..sources.records import clean_values

ON_MALFORMED = ("fail", "quarantine")


def clean_records(records: DataFrame) -> DataFrame:
    """Row-split job input filter: drop null or empty values."""
    return clean_values(records, "value")


def with_fields(records: DataFrame, sep: str = WIDE_FIELD_SEP, literal: bool = False,
                value: str = "value", out: str = "fields") -> DataFrame:
    """Add ``out`` = the value split into fields.

    ``literal=False``: single-character split keeping trailing empties (the
    row-split job). ``literal=True``: whole-separator split keeping all tokens
    (the dedup job); ``sep`` must already be decoded.
    """
    arr = split_literal(F.col(value), sep) if literal else split_csv(F.col(value), sep)
    return records.withColumn(out, arr)


def _describe(df: DataFrame) -> Column:
    cols = set(df.columns)
    parts = []
    for c in ("topic", "partition", "offset"):
        if c in cols:
            parts += [F.lit(f" {c}="), F.coalesce(F.col(c).cast("string"), F.lit("null"))]
    return F.concat(*parts) if parts else F.lit("")


def width_ok(fields, min_width: int) -> Column:
    return F.coalesce(F.size(as_col(fields)) >= F.lit(min_width), F.lit(False))


def width_error(fields, min_width: int, where: Column | None = None) -> Column:
    """``raise_error`` naming the short row (use as the failing branch)."""
    parts = [F.lit(f"row has fewer than {min_width} fields: "),
             F.coalesce(F.size(as_col(fields)).cast("string"), F.lit("null"))]
    if where is not None:
        parts.append(where)
    return F.raise_error(F.concat(*parts))


def guarded(ok: Column, value: Column, error: Column) -> Column:
    """``value`` when ``ok`` else fail. Put the guard inside an expression the
    plan must evaluate (a grouping key, a generator input): unlike a filter it
    is not pushed below the split, so the split runs once per row."""
    return F.when(ok, value).otherwise(error)


def require_width(df: DataFrame, min_width: int, fields: str = "fields",
                  on_malformed: str = "fail") -> DataFrame | tuple[DataFrame, DataFrame]:
    """Guard against rows with fewer than ``min_width`` fields.

    All columns of ``df`` are carried through the guard, so select what is
    needed first (the scan reads what reaches this point).
    ``fail``: every row goes through a one-element ``inline`` whose input
    raises on a short row. A generator cannot be pruned (``count()`` still
    evaluates it), and unlike a filter it is not pushed below the split, so
    the line is split once. ``quarantine``: returns ``(good, bad)``; ``bad``
    carries ``n_fields``.
    """
    if on_malformed not in ON_MALFORMED:
        raise ValueError(f"on_malformed must be one of {ON_MALFORMED}")
    ok = width_ok(fields, min_width)
    row = F.array(F.struct(*[F.col(c) for c in df.columns]))
    if on_malformed == "fail":
        return df.select(F.inline(guarded(ok, row, width_error(fields, min_width, _describe(df)))))
    good = keep_if(df, ok)
    bad = df.where(~ok).withColumn("n_fields", F.coalesce(F.size(fields), F.lit(0)))
    return good, bad


def keep_if(df: DataFrame, ok: Column) -> DataFrame:
    """Rows where ``ok`` holds, via a one-element ``inline`` rather than a
    filter: a filter on split-derived columns is pushed below the split and
    splits every line a second time."""
    return df.select(F.inline(F.when(ok, F.array(F.struct(*[F.col(c) for c in df.columns])))))


def project_fields(df: DataFrame, layout: Mapping[str, int], fields: str = "fields",
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """Positional -> named columns, from one ``name -> index`` mapping."""
    f = F.col(fields)
    return df.select(*keep, *[f[int(i)].alias(name) for name, i in layout.items()])


def project_signal(records: DataFrame, keep: tuple[str, ...] = ("offset",),
                   on_malformed: str = "fail"):
    """Wide signalling line -> its named fields (list cells stay raw text).

    Only ``keep`` and the split line go through the width guard, so the
    scan reads just those columns."""
    df = clean_records(records).select(*keep, split_csv(F.col("value"), WIDE_FIELD_SEP).alias("fields"))
    checked = require_width(df, WIDE_MIN_WIDTH, on_malformed=on_malformed)
    if on_malformed == "quarantine":
        good, bad = checked
        return project_fields(good, WIDE_LAYOUT, keep=keep), bad
    return project_fields(checked, WIDE_LAYOUT, keep=keep)
