"""Read positions on landed record tables.

The reference asks the broker for each partition's earliest and latest
offset, clamps a stored position into that range and would replay from
there. On a record table the same questions are aggregates and joins:

* bounds   = ``min(offset)`` and ``max(offset) + 1`` per (topic, partition)
* start    = stored position, else the reset policy (earliest / latest / none)
* resolved = start clamped into [earliest, latest], with a status
* replay   = records at or after the resolved start
* stored   = a table that each micro-batch adds its own positions to
* gaps     = offsets that are missing between those that are there

Inventory: S3 (start position), S5 (bounds), S6 (clamp, replay, stored positions, gaps, restart JSON).
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import scratch_path
from .records import RESET_POLICIES

KEYS = ["topic", "partition"]
POSITION_SCHEMA = "topic string, partition int, cur bigint"
#: Bits of an offset that one cell of the gap report covers: no window sorts more rows than that.
CELL_BITS = 16


def positions_frame(spark: SparkSession, positions: Sequence[tuple[str, int, int]]) -> DataFrame:
    """Driver-side stored positions ``(topic, partition, cur)`` as a DataFrame
    (from Arrow, so that the planner knows its size)."""
    topics, partitions, curs = ([x[i] for x in positions] for i in range(3))
    return spark.createDataFrame(pa.table({
        "topic": pa.array(topics, pa.string()), "partition": pa.array(map(int, partitions), pa.int32()),
        "cur": pa.array(map(int, curs), pa.int64())}))


def offset_bounds(records: DataFrame) -> DataFrame:
    """Earliest and latest (= last offset + 1) per topic partition."""
    return records.groupBy(*KEYS).agg(
        F.min("offset").alias("earliest"),
        (F.max("offset") + 1).alias("latest"),
    )


def footer_bounds(spark: SparkSession, path: str) -> DataFrame:
    """``offset_bounds`` of a table landed by ``sinks.land_by_partition``, from
    the statistics in its file footers: no row is read, whatever the size.

    Spark answers a minimum and maximum from footers when the groups are the
    table's partition columns and its file reader is the newer one, both of
    which are settings; they are set in a session of the frame's own, so the
    caller's stays as it is.
    """
    own = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        own.conf.set(key, spark.conf.get(key))
    v1 = [x for x in (spark.conf.get("spark.sql.sources.useV1SourceList") or "").split(",") if x and x != "parquet"]
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(v1))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return offset_bounds(own.read.schema("offset bigint, topic string, partition int").parquet(path))


def offset_gaps(records: DataFrame, cell_bits: int = CELL_BITS) -> DataFrame:
    """Missing offsets of each topic partition: ``topic, partition, first_missing,
    last_missing, missing``, one row per gap. What lies before the first or
    after the last offset is no gap.

    Offsets are dealt into cells of ``2 ** cell_bits``: a window per cell finds
    the gaps inside it, and leaves the cell's first and last offset as one row
    of the next level, whose cells are as many times wider. So a topic
    partition that holds a third of all records is never sorted in one task.
    """
    items = records.select(*KEYS, F.col("offset").alias("lo"), F.col("offset").alias("hi")).distinct()
    gaps = None
    for bits in [*range(cell_bits, 64, cell_bits), None]:
        cell = F.lit(0).cast("bigint") if bits is None else F.shiftright("lo", bits)
        here = items.withColumn("cell", cell)
        before = F.lag("hi").over(Window.partitionBy(*KEYS, "cell").orderBy("lo"))
        found = here.withColumn("before", before).where(F.col("lo") > F.col("before") + 1).select(
            *KEYS, (F.col("before") + 1).alias("first_missing"), (F.col("lo") - 1).alias("last_missing"))
        gaps = found if gaps is None else gaps.unionByName(found)
        items = here.groupBy(*KEYS, "cell").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("cell")
    return gaps.withColumn("missing", F.col("last_missing") - F.col("first_missing") + 1)


class PositionStore:
    """Positions that a stream keeps by itself, under ``path``: every
    micro-batch puts one row per topic partition that it read (the offset after
    its last), under ``batch=<epoch>``, so a replayed batch replaces its own.
    The stored position is the greatest of a partition's rows."""

    def __init__(self, path: str):
        self.path = path

    def put(self, batch: DataFrame, epoch: int) -> None:
        """Called when the batch's output is written: a crash before it replays
        the batch, one after it finds the position stored."""
        last = batch.groupBy(*KEYS).agg((F.max("offset") + 1).alias("cur"))
        last.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch={int(epoch)}")

    def read(self, spark: SparkSession) -> DataFrame:
        rows = spark.read.schema(POSITION_SCHEMA).parquet(self.path)
        return rows.groupBy(*KEYS).agg(F.max("cur").alias("cur"))

    def compact(self, spark: SparkSession) -> None:
        """Folds the rows of all batches into the newest one and removes the
        others. The folded rows are written before anything goes, so a reader
        (or a crash) at any time finds the same positions. Not while a stream
        puts its own."""
        fs_of = spark._jvm.org.apache.hadoop.fs
        root = fs_of.Path(self.path)
        fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
        batches = sorted((x.getPath() for x in fs.listStatus(root) if x.getPath().getName().startswith("batch=")),
                         key=lambda x: int(x.getName().partition("=")[2]))
        if len(batches) < 2:
            return
        folded = scratch_path(spark, "positions-folded")
        self.read(spark).coalesce(1).write.parquet(folded)
        rows = spark.read.schema(POSITION_SCHEMA).parquet(folded)
        rows.coalesce(1).write.mode("overwrite").parquet(batches[-1].toString())
        for x in batches[:-1]:
            fs.delete(x, True)

    def starting_offsets(self, spark: SparkSession) -> str:
        """The stored positions as a Kafka source's ``startingOffsets``, for a
        job that has lost its checkpoint."""
        stored = self.read(spark).select(*KEYS, F.col("cur").alias("start"))
        return starting_offsets_json(resolved_positions(stored))


def _place() -> Column:
    return F.concat(F.col("topic"), F.lit("-"), F.col("partition").cast("string"))


def _error(message: str, kind: str) -> Column:
    return F.raise_error(F.concat(F.lit(message), _place())).cast(kind)


def _refuse(df: DataFrame, columns: tuple[str, ...], message: str) -> DataFrame:
    """``df``, failing on the first row whose bigint ``columns`` are null (all
    come from one side of an outer join).

    The guard is in the columns and in a filter: counting or selecting other
    columns cannot prune it, and a later filter on one of them cannot turn the
    outer join below into an inner one that drops the row unseen.
    """
    missing = F.col(columns[0]).isNull()
    return (df.where(F.when(missing, _error(message, "boolean")).otherwise(F.lit(True)))
            .withColumns({c: F.when(missing, _error(message, "bigint")).otherwise(F.col(c)) for c in columns}))


def start_position(bounds: DataFrame, committed: DataFrame, reset: str = "latest") -> DataFrame:
    """Start per partition: the stored position, else the reset policy.

    ``reset="none"`` fails when a partition has no stored position. A stored
    position for a partition without bounds fails as well.
    Output: ``topic, partition, cur, source`` (source = committed / earliest / latest).
    """
    if reset not in RESET_POLICIES:
        raise ValueError(f"reset must be one of {RESET_POLICIES}")
    j = bounds.join(committed.select(*KEYS, F.col("cur").alias("stored")), KEYS, "full_outer")
    j = _refuse(j, ("earliest", "latest"), "no offsets known for stored position ")
    if reset == "none":
        j = _refuse(j, ("stored",), "no stored position and reset policy none for ")
    cur = F.col("stored") if reset == "none" else F.coalesce("stored", reset)
    source = F.when(F.col("stored").isNotNull(), F.lit("committed")).otherwise(F.lit(reset))
    return j.select(*KEYS, cur.alias("cur"), source.alias("source"))


def offset_resolve(bounds: DataFrame, positions: DataFrame) -> DataFrame:
    """Clamp each position into its partition's [earliest, latest].

    Output: ``topic, partition, cur, earliest, latest, start, status`` with
    status ``below`` / ``ok`` / ``above``. A position whose partition has no
    bounds raises, whichever columns are used.
    """
    j = _refuse(positions.select(*KEYS, "cur").join(bounds, KEYS, "left"), ("earliest", "latest"), "no offsets known for ")
    cur, lo, hi = F.col("cur"), F.col("earliest"), F.col("latest")
    start = F.when(cur < lo, lo).when(cur > hi, hi).otherwise(cur)
    status = F.when(cur < lo, "below").when(cur > hi, "above").otherwise("ok")
    return j.select(*KEYS, "cur", "earliest", "latest", start.alias("start"), status.alias("status"))


def replay_from_offsets(records: DataFrame, committed: DataFrame, reset: str = "none") -> DataFrame:
    """Records at or after each partition's start position, in one pass.

    Clamping a stored position into [earliest, latest] never changes which
    records lie at or after it (below the earliest: all of them; beyond the
    latest: none), so no bounds aggregate is needed: the records are joined
    with the stored positions and checked row by row. The join is left to
    Spark: a driver-side list has a known size and is broadcast, a stored
    table of positions is broadcast below the session's threshold, and beyond
    it the plan is a shuffle join whose hot partitions AQE splits.
    Partitions without a stored position follow ``reset``: ``earliest``
    replays them whole, ``latest`` skips them, ``none`` fails on their first
    record.
    ``offset_resolve`` reports the clamped starts and their status; a stored
    position for a partition with no landed records selects nothing here,
    and ``offset_resolve`` flags it as an error.
    """
    if reset not in RESET_POLICIES:
        raise ValueError(f"reset must be one of {RESET_POLICIES}")
    pos = committed.select(*KEYS, F.col("cur").alias("__start"))
    joined = records.join(pos, KEYS, "inner" if reset == "latest" else "left")
    start = F.col("__start")
    keep = F.col("offset") >= start
    if reset == "earliest":
        keep = start.isNull() | keep
    elif reset == "none":                # one expression: a filter of its own could be passed by
        keep = F.when(start.isNull(), _error("no stored position and reset policy none for ", "boolean")).otherwise(keep)
    return joined.where(keep).drop("__start")


# Kafka's JSON sentinels for a start position.
EARLIEST, LATEST = -2, -1


def starting_offsets_json(positions: Iterable[tuple[str, int, int]]) -> str:
    """``startingOffsets`` JSON for a Kafka source from ``(topic, partition,
    offset)``; offset -2 means earliest, -1 latest. A restart then reads
    exactly from the resolved positions (with ``failOnDataLoss=false`` for
    ones that were aged out meanwhile)."""
    out: dict[str, dict[str, int]] = {}
    for topic, partition, offset in positions:
        out.setdefault(str(topic), {})[str(int(partition))] = int(offset)
    return json.dumps(out, sort_keys=True)


def resolved_positions(resolved: DataFrame, max_rows: int = 100_000) -> list[tuple[str, int, int]]:
    """Resolved starts ``(topic, partition, start)`` as a driver-side list, for
    :func:`starting_offsets_json`. One row per topic partition; more than
    ``max_rows`` are refused, and never collected."""
    rows = resolved.select("topic", "partition", "start").limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"more than {max_rows} topic partitions: too many for a start-position map")
    return [(r["topic"], int(r["partition"]), int(r["start"])) for r in rows]
