"""Durable progress rows: what every micro-batch read, wrote and took.

One row per micro-batch, under ``batch=<id>`` of a folder beside the job's
checkpoint: a batch that is replayed after a failure replaces its row. Jobs
that run per batch (``foreachBatch``) put their row before the batch is
committed, so none can be lost; seconds are those of the batch's own work.
Plain streaming selects have no such place: a listener puts their rows from
the query's progress (rows by observed metrics, seconds of the whole trigger),
so a driver that dies between commit and event leaves a batch without a row.

Inventory: T4.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

#: ``first_batch_id`` and ``last_batch_id``: the least and greatest batch_id of the records read.
PROGRESS_SCHEMA = ("batch bigint, first_batch_id bigint, last_batch_id bigint, rows_in bigint, rows_out bigint, seconds double")
_ROW = ", ".join(PROGRESS_SCHEMA.split(", ")[1:])
READ, WRITTEN = "sigshape_read", "sigshape_written"


def read_metrics() -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), F.min("batch_id").alias("first"), F.max("batch_id").alias("last")]


def written_metrics() -> list[Column]:
    return [F.count(F.lit(1)).alias("rows")]


class ProgressTable:
    """The progress rows of one stream, under ``path``."""

    def __init__(self, path: str):
        self.path = path

    def put(self, spark: SparkSession, batch: int, first: int | None, last: int | None,
            rows_in: int, rows_out: int, seconds: float) -> None:
        row = spark.createDataFrame([(first, last, int(rows_in), int(rows_out), float(seconds))], _ROW)
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch={int(batch)}")

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(PROGRESS_SCHEMA).parquet(self.path).select(
            "batch", "first_batch_id", "last_batch_id", "rows_in", "rows_out", "seconds")

    @contextmanager
    def timed(self, batch: DataFrame, epoch: int) -> Iterator[tuple[DataFrame, Observation]]:
        """(the batch, observed as it is read; an observation for its result):
        puts the row when the block ends well. The result must be written from
        the batch given, in one action."""
        began = time.monotonic()
        read, written = Observation(f"{READ}_{epoch}"), Observation(f"{WRITTEN}_{epoch}")
        yield batch.observe(read, *read_metrics()), written
        of = read.get
        self.put(batch.sparkSession, epoch, of["first"], of["last"], of["rows"], written.get["rows"], time.monotonic() - began)


class ProgressListener(StreamingQueryListener):
    """Puts a row for every micro-batch of the stream ``name``, whose plan has
    the observations ``READ`` (of the records) and ``WRITTEN`` (of the result)."""

    def __init__(self, spark: SparkSession, table: ProgressTable, name: str):
        self.spark, self.table, self.name = spark, table, name
        self.ended = threading.Event()
        self._ours: set[str] = set()

    def onQueryStarted(self, event):
        if event.name == self.name:
            self._ours.add(str(event.runId))

    def onQueryProgress(self, event):
        p = event.progress
        took = p.durationMs or {}
        if p.name != self.name or "addBatch" not in took:
            return
        seen = p.observedMetrics or {}
        read, written = seen.get(READ), seen.get(WRITTEN)
        self.table.put(self.spark, p.batchId, read["first"] if read else None, read["last"] if read else None,
                       read["rows"] if read else p.numInputRows, written["rows"] if written else 0,
                       took.get("triggerExecution", 0) / 1000.0)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if str(event.runId) in self._ours:
            self.ended.set()
