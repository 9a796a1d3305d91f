"""Structured Streaming runners for the three jobs.

* row split and tap are stateless ``select``s: they run as plain streaming
  queries in append mode;
* dedup is per micro-batch, so it runs inside ``foreachBatch`` (a streaming
  ``groupBy`` would aggregate across batches, which the job never does).
  Each batch is written under ``epoch=<id>`` with overwrite, so a batch
  replayed after a failure replaces its own output instead of duplicating it.

The ``*_writer`` functions build stream writers (Kafka or files in, any
sink out) and ``start`` starts one with the job's processing-time trigger.
``run_landed`` streams a landed record table through a writer once, with
``availableNow``: one write of the source, one query, one micro-batch for each
``batch_id`` of the records, in their order.

Inventory: T1 (processing-time trigger), T2 (per-batch action), T3 (persist
only when a batch is read twice), T4 (progress rows), K4 stream sinks.
"""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from ..conf import DedupConf, RegionSplitConf
from ..operators.dedup import DEFAULT_METHOD, dedup, malformed_lines
from ..operators.explode import region_fanout, region_fanout_tagged
from ..operators.tap import tap_records
from ..session import scratch_path, unsorted_writes
from ..sources.offsets import PositionStore
from ..sources.records import RECORD_SCHEMA, stream_records
from ..sources.sinks import MESSAGE_ID, PLACE, file_options, land_in_batches, land_records, message_id, with_headers, write_messages
from .progress import READ, WRITTEN, ProgressListener, ProgressTable, read_metrics, written_metrics

log = logging.getLogger("sigshape.streaming")
FILE_SINKS = ("parquet", "orc", "json", "csv")


class BatchTimeLogger(StreamingQueryListener):
    """Logs every micro-batch of the session's streams: query name, batch id,
    input rows, seconds. ``on_batch`` also gets each entry; nothing is kept
    here, so a job may run for any length of time."""

    def __init__(self, on_batch: Callable[[tuple], None] | None = None):
        self.on_batch = on_batch

    def onQueryStarted(self, event):
        log.info("stream %s started", event.name or event.id)

    def onQueryProgress(self, event):
        p = event.progress
        secs = (p.durationMs or {}).get("triggerExecution", 0) / 1000.0
        entry = (p.name or str(p.id), int(p.batchId), int(p.numInputRows), round(secs, 3))
        log.info("stream %s batch %d: %d rows in %.3f s", *entry)
        if self.on_batch is not None:
            self.on_batch(entry)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        log.info("stream %s stopped%s", event.id, f": {event.exception}" if event.exception else "")


def parquet_batch_sink(out_path: str) -> Callable[[DataFrame, int], None]:
    """Write one batch under ``epoch=<id>`` with overwrite: a batch replayed
    after a failure replaces its own output instead of duplicating it."""
    def write(df: DataFrame, epoch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{out_path}/epoch={epoch_id}")
    return write


def message_batch_sink(sink: str, out_path: str | None, options: dict | None = None) -> Callable[[DataFrame, int], None]:
    """Write one batch of messages through ``write_messages``: Kafka, or files
    of any format under ``epoch=<id>/topic=<t>`` with overwrite."""
    def write(df: DataFrame, epoch_id: int) -> None:
        path = None if sink == "kafka" else f"{out_path}/epoch={epoch_id}"
        write_messages(df, sink, path, options, mode="overwrite")
    return write


def dedup_message_id() -> Column:
    """A dedup message is told by its batch and key, of which it is the only one."""
    return message_id("batch_id", "key")


def kafka_batch_sink(options: dict, topic: str) -> Callable[[DataFrame, int], None]:
    """Send ``(topic, key, value)`` messages of one batch to Kafka
    (at-least-once: a replayed batch is sent again, with the same message ids
    in the headers)."""
    def write(df: DataFrame, epoch_id: int) -> None:
        sent = df.select(F.lit(topic).alias("topic"), "key", "value", dedup_message_id().alias(MESSAGE_ID))
        write_messages(sent, "kafka", options=options)
    return write


@dataclass
class DedupBatchWriter:
    """``foreachBatch`` body: dedup one micro-batch and hand it to a sink.

    Records without a ``batch_id`` (a live topic) get the micro-batch id; a
    landed table keeps the batch it was recorded in. ``progress`` gets a row of
    the batch's records, lines and seconds, counted as they are written;
    ``positions`` keeps how far each topic partition was read.
    With ``conf.on_malformed="quarantine"`` short lines go to ``quarantine``
    instead of failing the batch (a failing batch would be retried forever).
    A batch that is read more than once is persisted.
    """
    out_path: str | None = None
    conf: DedupConf = DedupConf()
    method: str = DEFAULT_METHOD
    sink: Callable[[DataFrame, int], None] | None = None
    quarantine: Callable[[DataFrame, int], None] | None = None
    progress: ProgressTable | None = None
    positions: PositionStore | None = None

    def __call__(self, batch: DataFrame, epoch_id: int) -> None:
        began = time.time()
        batch = batch.withColumn("batch_id", F.coalesce(F.col("batch_id"), F.lit(epoch_id).cast("bigint")))
        set_aside = self.conf.on_malformed == "quarantine" and self.quarantine is not None
        again = set_aside or self.positions is not None
        if again:
            batch = batch.persist()
        try:
            send = self.sink or parquet_batch_sink(self.out_path)
            if self.progress is None:
                send(dedup(batch, self.conf, self.method), epoch_id)
            else:
                with self.progress.timed(batch, epoch_id) as (read, written):
                    send(dedup(read, self.conf, self.method).observe(written, *written_metrics()), epoch_id)
            if set_aside:
                self.quarantine(malformed_lines(batch, self.conf), epoch_id)
            if self.positions is not None:       # last: a position is stored when its records are done
                self.positions.put(batch, epoch_id)
        finally:
            if again:
                batch.unpersist()
        log.info("dedup batch %d: %.3f s", epoch_id, time.time() - began)


@dataclass
class RegionSplitBatchWriter:
    """``foreachBatch`` body for the row split in quarantine mode: messages
    to ``sink``, malformed lines (too narrow, short companion list) to
    ``quarantine``. Lines are split once, into one persisted frame."""
    sink: Callable[[DataFrame, int], None]
    quarantine: Callable[[DataFrame, int], None]
    conf: RegionSplitConf = RegionSplitConf(on_malformed="quarantine")
    progress: ProgressTable | None = None

    def __call__(self, batch: DataFrame, epoch_id: int) -> None:
        if self.progress is None:
            return self._split(batch, epoch_id, lambda good: good)
        with self.progress.timed(batch, epoch_id) as (read, written):
            self._split(read, epoch_id, lambda good: good.observe(written, *written_metrics()))

    def _split(self, batch: DataFrame, epoch_id: int, watched: Callable[[DataFrame], DataFrame]) -> None:
        batch = batch.withColumnRenamed("topic", PLACE[0])
        out = region_fanout_tagged(batch, self.conf, keep=PLACE, seq="seq").persist()
        try:
            good = out.where("reason is null").select("topic", "key", "value", message_id(*PLACE, "seq").alias(MESSAGE_ID))
            self.sink(watched(good), epoch_id)
            self.quarantine(out.where("reason is not null").select(*PLACE, "n_fields", "reason"), epoch_id)
        finally:
            out.unpersist()


def landing_writer(stream: DataFrame, path: str) -> DataStreamWriter:
    """Land a record stream: each micro-batch under ``batch_id=<epoch>``
    (overwrite, so a replayed batch replaces itself)."""
    return stream.writeStream.foreachBatch(lambda df, epoch: land_records(df, path, epoch))


def region_split_writer(stream: DataFrame, out_path: str | None, conf: RegionSplitConf = RegionSplitConf(),
                        sink: str = "parquet", sink_options: dict | None = None,
                        quarantine_path: str | None = None, progress: ProgressTable | None = None) -> DataStreamWriter:
    """Fan-out messages of a record stream to a sink (Kafka or files), each
    with the id of its source record and place in it (``message_id``; in
    Kafka a header), which a replayed batch repeats.

    ``fail`` mode is a plain streaming select (append). ``quarantine`` mode
    runs per batch: messages to the same sink, files under
    ``out_path/epoch=<id>/topic=<t>``; malformed lines under
    ``quarantine_path/epoch=<id>``. ``progress`` is for that mode; a plain
    select's rows come from the listener of ``start``.
    """
    if conf.on_malformed == "quarantine":
        if quarantine_path is None:
            raise ValueError("quarantine mode needs a quarantine_path")
        body = RegionSplitBatchWriter(message_batch_sink(sink, out_path, sink_options),
                                      parquet_batch_sink(quarantine_path), conf, progress)
        return stream.writeStream.foreachBatch(body)
    read = stream.observe(READ, *read_metrics()).withColumnRenamed("topic", PLACE[0])
    messages = region_fanout(read, conf, keep=PLACE, seq="seq").observe(WRITTEN, *written_metrics())
    messages = messages.select("topic", "key", "value", message_id(*PLACE, "seq").alias(MESSAGE_ID))
    if sink == "kafka":
        messages = with_headers(messages)
    options = file_options(sink, sink_options) if sink in FILE_SINKS else sink_options or {}
    w = messages.writeStream.outputMode("append").format(sink).options(**options)
    if sink in FILE_SINKS:
        return w.partitionBy("topic").option("path", out_path)
    return w if sink != "memory" else w.queryName(out_path or "region_messages")


def tap_writer(stream: DataFrame, out_path: str, sink: str = "parquet") -> DataStreamWriter:
    """Tap lines to a sink, every record of every batch: ``text`` for plain
    log-like files (line only), ``console`` for eyes, ``parquet`` for checks
    (with partition and offset)."""
    lines = tap_records(stream.observe(READ, *read_metrics())).observe(WRITTEN, *written_metrics())
    if sink == "text":
        lines = lines.select("line")
    w = lines.writeStream.outputMode("append").format(sink)
    if sink == "console":
        return w.option("truncate", "false").option("numRows", str(2**31 - 1))
    if sink == "memory":
        return w.queryName(out_path or "tap_lines")
    return w.option("path", out_path)


def records_writer(stream: DataFrame, out_path: str) -> DataStreamWriter:
    return stream.writeStream.outputMode("append").format("parquet").option("path", out_path)


def dedup_writer(stream: DataFrame, out_path: str | None, conf: DedupConf = DedupConf(),
                 method: str = DEFAULT_METHOD, sink=None, quarantine_path: str | None = None,
                 progress: ProgressTable | None = None,
                 positions: PositionStore | None = None) -> tuple[DataStreamWriter, DedupBatchWriter]:
    quarantine = parquet_batch_sink(quarantine_path) if quarantine_path else None
    if conf.on_malformed == "quarantine" and quarantine is None:
        raise ValueError("quarantine mode needs a quarantine_path")
    body = DedupBatchWriter(out_path, conf, method, sink, quarantine, progress, positions)
    return stream.writeStream.foreachBatch(body), body


def start(writer: DataStreamWriter, checkpoint: str, interval_s: int | None = None, available_now: bool = False,
          listen: tuple[SparkSession, ProgressTable] | None = None) -> StreamingQuery:
    """Start with a processing-time trigger (the job's batch interval) or,
    for replays, ``availableNow``. ``listen``: a plain streaming select puts
    its progress rows into that table by a listener."""
    w = writer.option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif interval_s:
        w = w.trigger(processingTime=f"{int(interval_s)} seconds")
    if listen is None:
        return w.start()
    spark, table = listen
    name = f"sigshape-{uuid.uuid4().hex[:12]}"
    listener = ProgressListener(spark, table, name)
    spark.streams.addListener(listener)
    q = w.queryName(name).start()
    q.progress_listener = listener                 # for ``finish``
    return q


def finish(q: StreamingQuery) -> None:
    """Waits for the end of a query and of its progress rows."""
    q.awaitTermination()
    listener = getattr(q, "progress_listener", None)
    if listener is not None:
        listener.ended.wait(60)                    # events arrive in order: the end comes last
        listener.spark.streams.removeListener(listener)
    if q.exception() is not None:
        raise q.exception()


def run_landed(spark: SparkSession, records: DataFrame, name: str,
               make_writer: Callable[[DataFrame, str], DataStreamWriter], progress: ProgressTable | None = None) -> str:
    """Streams a record table through a writer and returns the output folder.

    The table is written once, as the stream's source, and read by one query
    with ``availableNow``, which takes the files of one ``batch_id`` at a time:
    every batch is a micro-batch of its own. ``progress``: for plain selects
    (per-batch writers put their rows themselves).
    """
    root = scratch_path(spark, name)
    source, out = f"{root}/source", f"{root}/out"
    as_records = [F.col(f.name).cast(f.dataType).alias(f.name) for f in RECORD_SCHEMA.fields]
    files = land_in_batches(records.select(*as_records), source)
    stream = stream_records(spark, "parquet", source, max_files_per_trigger=files)
    with unsorted_writes(spark):                   # a stream keeps the settings it is started with
        query = start(make_writer(stream, out), f"{root}/checkpoint", available_now=True,
                      listen=(spark, progress) if progress is not None else None)
    finish(query)
    return out


def run_dedup(spark: SparkSession, records: DataFrame, conf: DedupConf = DedupConf(),
              method: str = DEFAULT_METHOD, name: str = "stream-dedup") -> tuple[DataFrame, DataFrame]:
    """Per-batch dedup of a landed table as a stream: ``(result, progress)``."""
    progress = ProgressTable(scratch_path(spark, f"{name}-progress"))
    out = run_landed(spark, records, name, lambda stream, path: dedup_writer(
        stream, f"{path}/rows", conf, method, progress=progress)[0])
    return spark.read.parquet(f"{out}/rows").select("batch_id", "key", "value"), progress.read(spark)
