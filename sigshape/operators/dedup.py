"""Per-batch dedup: keep one line per composite key inside each batch.

Scope is one batch only; nothing is carried from batch to batch. On a
table the batch is the ``batch_id`` column; on a stream the runner calls the
same functions inside ``foreachBatch``.

Plans: ``row_number() = 1`` over (batch_id, key) plans as Sort ->
WindowGroupLimit (partial) -> Exchange -> Sort -> WindowGroupLimit -> Window,
and ``max_by`` as a partial + final SortAggregate. Either way each map task
ships at most one row per (batch, key) to the shuffle, so a key holding a
third of all rows costs the same shuffle volume as any other key.

Inventory: A1, A2, A3, K1 (dedup messages).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..conf import DedupConf
from ..functions.split import decode_escapes, split_literal
from ..functions.text import composite_key
from ..sources.records import clean_values
from .parse import guarded, keep_if, width_error, width_ok

METHODS = ("max_by", "row_number")
DEFAULT_METHOD = "row_number"
# What names a record: the tie rule's columns.
PLACE = ("topic", "partition", "offset")


def _split_lines(records: DataFrame, conf: DedupConf, keep=()) -> DataFrame:
    df = clean_values(records) if conf.drop_blank else records
    sep = decode_escapes(conf.separator)
    return df.select(*keep, "batch_id", "topic", "partition", "offset", "value",
                     split_literal(F.col("value"), sep).alias("fields"))


def keyed_lines(records: DataFrame, conf: DedupConf = DedupConf(), keep=()) -> DataFrame:
    """Split each line with the configured literal separator and attach
    ``key`` (fields joined by ``_``) and ``time`` (the time field as text).

    Null, empty or short lines fail the batch unless ``conf.drop_blank``
    drops null/empty ones first, or ``conf.on_malformed="quarantine"`` leaves
    them out (see :func:`malformed_lines`). The width check lives in the key,
    which the aggregate must evaluate, so it is not pruned and the split
    runs once.
    """
    df = _split_lines(records, conf, keep)
    fields = F.col("fields")
    ok = width_ok(fields, conf.min_width)
    key = composite_key(fields, conf.key_index)
    if conf.on_malformed == "quarantine":
        df = keep_if(df, ok)
    else:
        key = guarded(ok, key, width_error(fields, conf.min_width))
    cols = [*keep, "batch_id", "topic", "partition", "offset", "value", key.alias("key")]
    if conf.distinct_by_time:
        cols.append(F.get(fields, int(conf.time_index)).alias("time"))
    return df.select(*cols)


def malformed_lines(records: DataFrame, conf: DedupConf = DedupConf()) -> DataFrame:
    """Lines too short for the configured key and time fields (null and
    empty lines included unless ``drop_blank``), with their field count."""
    df = _split_lines(records, conf)
    return (df.where(~width_ok(F.col("fields"), conf.min_width))
            .select("batch_id", "topic", "partition", "offset", "value",
                    F.coalesce(F.size("fields"), F.lit(0)).alias("n_fields")))


def dedup_latest(records: DataFrame, conf: DedupConf = DedupConf(), method: str = DEFAULT_METHOD) -> DataFrame:
    """Newest line per (batch_id, key): greatest time *as text*.

    Ties on time go to the greatest (topic, partition, offset): a record's
    place in its source, so every plan and every order of the input picks the
    same record.
    Output: ``batch_id, key, value``.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    k = keyed_lines(records, conf)
    if method == "max_by":
        return k.groupBy("batch_id", "key").agg(
            F.max_by("value", F.struct("time", *PLACE)).alias("value"))
    w = Window.partitionBy("batch_id", "key").orderBy(
        F.col("time").desc(), *[F.col(c).desc() for c in PLACE])
    return (k.withColumn("__rn", F.row_number().over(w))
            .where(F.col("__rn") == 1).select("batch_id", "key", "value"))


def dedup_any(records: DataFrame, conf: DedupConf = DedupConf(), method: str = DEFAULT_METHOD) -> DataFrame:
    """Any one line per (batch_id, key). The pick is fixed to the lowest
    (topic, partition, offset) so results are repeatable. ``method="max_by"``
    selects the aggregate plan (here ``min_by``), ``"row_number"`` the window
    plan."""
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    k = keyed_lines(records, DedupConf(**{**conf.__dict__, "distinct_by_time": False}))
    if method == "max_by":
        return k.groupBy("batch_id", "key").agg(
            F.min_by("value", F.struct(*PLACE)).alias("value"))
    w = Window.partitionBy("batch_id", "key").orderBy(*PLACE)
    return (k.withColumn("__rn", F.row_number().over(w))
            .where(F.col("__rn") == 1).select("batch_id", "key", "value"))


def dedup(records: DataFrame, conf: DedupConf = DedupConf(), method: str = DEFAULT_METHOD) -> DataFrame:
    """The dedup job's choice between newest and any, from the configuration."""
    return (dedup_latest(records, conf, method) if conf.distinct_by_time
            else dedup_any(records, conf, method))


def dedup_messages(records: DataFrame, conf: DedupConf = DedupConf(), method: str = DEFAULT_METHOD) -> DataFrame:
    """Dedup result as sink messages ``(topic, key, value)``; value is the
    original line (not a JVM array identity string)."""
    return dedup(records, conf, method).select(
        F.lit(conf.topic_out).alias("topic"), "key", "value")
