"""Message sinks: ``(topic, key, value)`` frames to Kafka or to files.

Kafka routes each message by its ``topic`` column and partitions by ``key``
(so one key stays in one output partition). Files are written partitioned
by topic, so a reader of one topic prunes to its folder.

A message may carry ``message_id``: the place of its source record (topic,
partition, offset) and its own place in it, so a batch that is replayed sends
the same ids again, whichever tasks run it, and ``drop_resent`` recognises
them. Files keep it as a column, Kafka as a header.

Inventory: K1 (keyed message sink), K3 (producer batching).
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path, shuffles_removed, unsorted_writes
from .records import RECORD_COLUMNS

MESSAGE_COLUMNS = ("topic", "key", "value")
MESSAGE_ID = "message_id"
#: Where a message's source record stands; ``source_topic``, since a message has a topic of its own.
PLACE = ("source_topic", "partition", "offset")
#: Codecs of files, by format, where the caller names none (readers know them by footer or file name).
COMPRESSION = {"parquet": "zstd", "orc": "zstd"}
#: Files of a batch in a table that is streamed batch by batch.
BATCH_FILES = 8
#: Slices of ids that ``settle_resent`` takes at most, and bytes of files that are worth one.
SLICES, SLICE_BYTES = 4, 64_000_000


def producer_options(batch_size_bytes: int | None = None, linger_ms: int | None = None) -> dict:
    """Producer batching for the Kafka sink (bulk sends are the producer's job)."""
    opts = {}
    if batch_size_bytes:
        opts["kafka.batch.size"] = str(int(batch_size_bytes))
    if linger_ms is not None:
        opts["kafka.linger.ms"] = str(int(linger_ms))
    return opts


def file_options(sink: str, options: dict | None = None) -> dict:
    """The caller's options of a file sink, or its codec."""
    given = dict(options or {})
    if sink in COMPRESSION and not any(k.lower() in ("compression", "codec") for k in given):
        given["compression"] = COMPRESSION[sink]
    return given


def message_id(*parts: str | Column) -> Column:
    """The parts as text, ``/``-joined; nulls count as blank. Only the last
    part may hold a ``/`` of its own, so different places have different ids."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.concat_ws("/", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])


def with_headers(messages: DataFrame) -> DataFrame:
    """Messages for the Kafka sink: the message id as a header."""
    header = F.struct(F.lit("message-id").alias("key"), F.col(MESSAGE_ID).cast("binary").alias("value"))
    return messages.select(*MESSAGE_COLUMNS, F.array(header).alias("headers"))


def write_messages(messages: DataFrame, sink: str = "parquet", path: str | None = None,
                   options: dict | None = None, mode: str = "append") -> None:
    """Write a message frame once (a table run, or one micro-batch)."""
    named = MESSAGE_ID in messages.columns
    df = messages.select(*MESSAGE_COLUMNS, *([MESSAGE_ID] if named else []))
    if sink == "kafka":
        df = with_headers(df) if named else df
        df.write.format("kafka").options(**(options or {})).save()
    else:
        with unsorted_writes(df.sparkSession):
            df.write.mode(mode).partitionBy("topic").format(sink).options(**file_options(sink, options)).save(path)


def _near() -> Column:
    """One value for up to a hundred messages of a line: the id without its last two characters."""
    return F.xxhash64(F.left(F.col(MESSAGE_ID), F.length(MESSAGE_ID) - 2))


def drop_resent(messages: DataFrame) -> DataFrame:
    """One message of each id: what a batch that was replayed, or a task that
    was tried again, sent more than once is kept once.

    Rows are dealt by their id without its last two characters: up to a hundred
    messages of a line stay together in the shuffle and compress well, for they
    share most of their text; a line with more of them falls to many tasks. The
    number of parts is named: merged by their compressed size they would spill.
    The value they are dealt by is not shuffled with them, but taken again.
    """
    parts = int(messages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = messages.repartition(parts, _near()).withColumn("__near", _near())
    return dealt.dropDuplicates(["__near", MESSAGE_ID]).drop("__near")


def settle_resent(messages: DataFrame, columns: tuple[str, ...] = MESSAGE_COLUMNS) -> DataFrame:
    """``drop_resent`` for tables whose shuffle is large on disk: the ids are
    taken in up to ``SLICES`` slices, one after another. A slice is written
    under ``spark.checkpoint.dir`` and its shuffle files go before the next
    begins, so a quarter of the shuffle is on disk at once; ``messages`` is
    read once a slice. Below ``SLICE_BYTES`` there is one slice, not written.
    """
    spark = messages.sparkSession
    size = int(str(messages._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    slices = min(SLICES, -(-size // SLICE_BYTES))
    if slices <= 1:
        return drop_resent(messages).select(*columns)
    path = scratch_path(spark, "sink-settled")
    out = messages.select(*columns)
    messages = messages.select(*dict.fromkeys((*columns, MESSAGE_ID)))
    for k in range(slices):
        part = messages.where(F.pmod(_near(), F.lit(slices)) == k)
        with shuffles_removed(spark):
            drop_resent(part).select(*columns).write.mode("append").options(**file_options("parquet")).parquet(path)
    return spark.read.schema(out.schema).parquet(path)


def land_records(records: DataFrame, path: str, batch_id: int | None = None) -> None:
    """Land records as a table the offset operators and replays can read.

    With ``batch_id`` (one micro-batch) the batch goes to
    ``path/batch_id=<id>/topic=<t>/`` with overwrite, so a replayed batch
    replaces itself; without it every batch and topic in ``records`` is
    replaced (dynamic partition overwrite), others stay, so a retried landing
    duplicates nothing. Rows are dealt by (batch, topic) in parts that Spark
    evens out by size (a rebalance): small folders become one file, a topic of
    any size as many tasks and files as its data needs. Read back with ``read_records(spark,
    "parquet", path)``; a topic filter then prunes folders. Read from Kafka,
    each task holds one topic partition, so a micro-batch lands as one file
    per topic partition (no small-file blow-up from the topic split).
    """
    if batch_id is None:
        (records.select(*RECORD_COLUMNS).hint("rebalance", F.col("batch_id"), F.col("topic"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id", "topic").parquet(path))
        return
    (records.select(*[c for c in RECORD_COLUMNS if c != "batch_id"])
     .write.mode("overwrite").partitionBy("topic").parquet(f"{path}/batch_id={int(batch_id)}"))


def land_by_partition(records: DataFrame, path: str) -> None:
    """Land records under ``topic=<t>/partition=<p>``, the layout whose offset
    bounds stand in the file footers (``offsets.footer_bounds``). Overwrites."""
    (records.select(*[c for c in RECORD_COLUMNS if c != "batch_id"]).hint("rebalance", F.col("topic"), F.col("partition"))
     .write.mode("overwrite").partitionBy("topic", "partition").parquet(path))


def land_in_batches(records: DataFrame, path: str, files: int = BATCH_FILES, mode: str = "overwrite") -> int:
    """Land records so that a file stream reads them batch by batch: returns
    the number of files to read per trigger.

    One write puts every batch into ``batch_id=<id>`` as ``files`` files at
    most. A file stream takes files by their time, so the files of a batch get
    the same time, a second after those of the batch before; batches with
    fewer files than the fullest get empty ones. The driver sees file names
    only. Needs a file system that can set times. ``mode="append"`` adds later
    batches; a stream that goes on has seen the earlier files.
    """
    spark = records.sparkSession
    salt = F.pmod(F.xxhash64("topic", "partition", "offset"), F.lit(int(files)))
    with unsorted_writes(spark):
        (records.select(*RECORD_COLUMNS).repartition("batch_id", salt)
         .write.mode(mode).partitionBy("batch_id").options(**file_options("parquet")).parquet(path))
    fs_of = spark._jvm.org.apache.hadoop.fs
    root = fs_of.Path(path)
    conf = spark._jsc.hadoopConfiguration()
    fs = root.getFileSystem(conf)

    def parts(folder) -> list:
        return [x.getPath() for x in fs.listStatus(folder) if x.getPath().getName().startswith("part-")]

    folders = {x.getPath().getName().partition("=")[2]: x.getPath() for x in fs.listStatus(root) if x.isDirectory()}
    batches = sorted(folders, key=lambda b: int(b) if b.lstrip("-").isdigit() else -1 << 63)     # no id: first
    held = {b: parts(folders[b]) for b in batches}
    most = max(map(len, held.values()), default=1)
    empty = None
    began = int(time.time() * 1000) - 1000 * len(batches)
    for k, b in enumerate(batches):
        while len(held[b]) < most:
            if empty is None:
                blank = scratch_path(spark, "empty-batch")
                records.drop("batch_id").limit(0).write.mode("overwrite").parquet(blank)
                empty = parts(fs_of.Path(blank))[0]
            to = fs_of.Path(folders[b], f"part-empty-{len(held[b])}.parquet")
            fs_of.FileUtil.copy(fs, empty, fs, to, False, conf)
            held[b].append(to)
        for x in held[b]:
            fs.setTimes(x, began + 1000 * k, -1)
    return most
