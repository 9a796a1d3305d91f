"""The three streaming jobs, ready to run against Kafka (or landed files).

* ``region_split_job``: wide signalling lines -> current-region messages to
  ``topic_in`` and left-region messages to ``topic_out`` (one pass).
* ``dedup_job``: one line per composite key inside each micro-batch ->
  ``topic_out``.
* ``tap_job``: ``key:<key>value:<value>`` for every record -> text files (or
  the console).

Each job reads the record source, applies the table operators unchanged,
and starts a query with a processing-time trigger equal to the configured
batch interval (the interval is the dedup window). Checkpoints live under
the session's ``spark.checkpoint.dir`` at a stable path per job and input
(topics or folder), so two jobs on different inputs never share one and a
restart resumes where the last committed batch ended (at-least-once to
Kafka, with message ids that tell what was sent again; idempotent per batch to
files). Beside the checkpoint stand ``<job>-progress`` (a row per micro-batch:
records, messages, seconds) and, for dedup, ``<job>-positions`` (how far each
topic partition was read).

Command line (arguments instead of a properties file)::

    python -m sigshape.plans.jobs region-split --brokers h:9092 --topics in \\
        --topic-in region_in --topic-out region_out

Inventory: the three jobs end to end; S3/S4 via ``KafkaEnds``.
"""

from __future__ import annotations

import argparse
import hashlib
import logging
from dataclasses import dataclass, replace

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..conf import DedupConf, RegionSplitConf, TapConf
from ..operators.dedup import DEFAULT_METHOD
from ..session import JOB_CONF, job_path
from ..sources.offsets import PositionStore
from ..sources.records import kafka_options, stream_records, topic_set
from ..sources.sinks import producer_options
from ..streaming.progress import ProgressTable
from ..streaming.runners import (BatchTimeLogger, dedup_writer, finish, kafka_batch_sink,
                                 region_split_writer, start, tap_writer)


@dataclass(frozen=True)
class KafkaEnds:
    """Where records come from and where messages go."""
    brokers: str
    topics: str                                   # comma list, as configured
    # The row split and the tap always connect secured; the dedup job's
    # properties file has a switch for it.
    secured: bool = True
    starting: str = "latest"                      # reset policy for the first start
    starting_offsets_json: str | None = None
    group_id: str | None = None
    out_brokers: str | None = None                # defaults to ``brokers``
    # Offsets that were aged out before they were read fail the job; False
    # skips them (an incomplete result).
    fail_on_data_loss: bool = True
    # A cap bounds a catch-up batch after an outage. The dedup job refuses it:
    # there it would change which lines share a batch, and so the answer.
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None             # split fat topic partitions over more tasks
    producer_batch_bytes: int | None = None       # producer batching (the bulk send)
    producer_linger_ms: int | None = None

    def source_options(self) -> dict:
        extra = {"failOnDataLoss": str(bool(self.fail_on_data_loss)).lower()}
        if self.max_offsets_per_trigger:
            extra["maxOffsetsPerTrigger"] = str(int(self.max_offsets_per_trigger))
        if self.min_partitions:
            extra["minPartitions"] = str(int(self.min_partitions))
        return kafka_options(self.brokers, self.topics, secured=self.secured, starting=self.starting,
                             starting_offsets_json=self.starting_offsets_json,
                             group_id=self.group_id, extra=extra)

    def sink_options(self) -> dict:
        opts = {"kafka.bootstrap.servers": self.out_brokers or self.brokers,
                "kafka.security.protocol": "SASL_PLAINTEXT" if self.secured else "PLAINTEXT"}
        if self.secured:
            opts["kafka.sasl.kerberos.service.name"] = "kafka"
        opts.update(producer_options(self.producer_batch_bytes, self.producer_linger_ms))
        return opts


def _source(spark: SparkSession, ends: KafkaEnds | None, path: str | None, fmt: str = "parquet"):
    if ends is not None:
        return stream_records(spark, "kafka", options=ends.source_options())
    return stream_records(spark, fmt, path)


def _job_name(job: str, given: str | None, topics: str) -> str:
    return given or f"{job}-{hashlib.md5(','.join(sorted(topic_set(topics))).encode()).hexdigest()[:12]}"


def _name(job: str, given: str | None, ends: KafkaEnds | None, path: str | None) -> str:
    """A job's folder name: the given one, else the job and a digest of its input."""
    if ends is not None:
        return _job_name(job, given, ends.topics)
    return given or f"{job}-{hashlib.md5(str(path).encode()).hexdigest()[:12]}"


def _quarantine_path(spark, name, on_malformed, given):
    if on_malformed != "quarantine":
        return None
    return given or job_path(spark, f"{name}-quarantine")


def region_split_job(spark: SparkSession, conf: RegionSplitConf = RegionSplitConf(),
                     ends: KafkaEnds | None = None, in_path: str | None = None,
                     out_path: str | None = None, name: str | None = None,
                     quarantine_path: str | None = None, available_now: bool = False,
                     in_format: str = "parquet") -> StreamingQuery:
    name = _name("region-split", name, ends, in_path)
    stream = _source(spark, ends, in_path, in_format)
    qpath = _quarantine_path(spark, name, conf.on_malformed, quarantine_path)
    progress = ProgressTable(job_path(spark, f"{name}-progress"))
    if ends is not None:
        writer = region_split_writer(stream, None, conf, sink="kafka", sink_options=ends.sink_options(),
                                     quarantine_path=qpath, progress=progress)
    else:
        writer = region_split_writer(stream, out_path, conf, quarantine_path=qpath, progress=progress)
    return start(writer, job_path(spark, name), interval_s=conf.batch_interval_s, available_now=available_now,
                 listen=(spark, progress) if conf.on_malformed != "quarantine" else None)


def dedup_job(spark: SparkSession, conf: DedupConf = DedupConf(), ends: KafkaEnds | None = None,
              in_path: str | None = None, out_path: str | None = None,
              method: str = DEFAULT_METHOD, name: str | None = None,
              quarantine_path: str | None = None, available_now: bool = False,
              in_format: str = "parquet") -> StreamingQuery:
    if ends is not None and ends.max_offsets_per_trigger:
        raise ValueError("the dedup job takes no rate cap: its batch is whatever arrived in the interval")
    name = _name("dedup", name, ends, in_path)
    stream = _source(spark, ends, in_path, in_format)
    sink = kafka_batch_sink(ends.sink_options(), conf.topic_out) if ends is not None else None
    qpath = _quarantine_path(spark, name, conf.on_malformed, quarantine_path)
    writer, _ = dedup_writer(stream, out_path, conf, method, sink, qpath,
                             ProgressTable(job_path(spark, f"{name}-progress")), PositionStore(job_path(spark, f"{name}-positions")))
    return start(writer, job_path(spark, name), interval_s=conf.batch_interval_s,
                 available_now=available_now)


def tap_job(spark: SparkSession, conf: TapConf = TapConf(), ends: KafkaEnds | None = None,
            in_path: str | None = None, sink: str = "text", out_path: str | None = None,
            name: str | None = None, available_now: bool = False,
            in_format: str = "parquet") -> StreamingQuery:
    """Every record as a line of text files (default: under the job's folder)."""
    name = _name("tap", name, ends, in_path)
    if out_path is None and sink not in ("console", "memory"):
        out_path = job_path(spark, f"{name}-lines")
    writer = tap_writer(_source(spark, ends, in_path, in_format), out_path, sink)
    listen = (spark, ProgressTable(job_path(spark, f"{name}-progress"))) if sink != "memory" else None
    return start(writer, job_path(spark, name), interval_s=conf.batch_interval_s,
                 available_now=available_now, listen=listen)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m sigshape")
    p.add_argument("job", choices=["region-split", "dedup", "tap"])
    p.add_argument("--properties", help="Java-style properties file with the job settings")
    p.add_argument("--brokers", help="Kafka brokers (else --in-path reads landed record files)")
    p.add_argument("--topics", help="comma list of input topics")
    p.add_argument("--in-path", help="folder of landed record files (instead of Kafka)")
    p.add_argument("--in-format", default="parquet", help="file format of --in-path (parquet, orc, json)")
    p.add_argument("--out-path", help="output folder when not writing to Kafka")
    p.add_argument("--name", help="job name (its checkpoint folder under spark.checkpoint.dir)")
    p.add_argument("--available-now", action="store_true",
                   help="process what is there, then stop (instead of a processing-time trigger)")
    p.add_argument("--secured", action=argparse.BooleanOptionalAction,
                   help="SASL connection (default: on, except for dedup)")
    p.add_argument("--starting", choices=["earliest", "latest", "none"])
    p.add_argument("--starting-offsets-json")
    p.add_argument("--from-positions", action="store_true",
                   help="dedup: start from the positions an earlier run of the job stored (its checkpoint being lost)")
    p.add_argument("--group-id")
    p.add_argument("--interval", type=int)
    p.add_argument("--topic-in")
    p.add_argument("--topic-out")
    p.add_argument("--key-index")
    p.add_argument("--time-index", type=int)
    p.add_argument("--separator")
    p.add_argument("--any", action="store_true", help="dedup: keep any row, not the newest")
    p.add_argument("--drop-blank", action="store_true", help="dedup: leave null and empty lines out")
    p.add_argument("--allow-data-loss", action="store_true",
                   help="skip offsets that were aged out instead of failing")
    p.add_argument("--console", action="store_true", help="tap: print the lines")
    p.add_argument("--max-offsets-per-trigger", type=int)
    p.add_argument("--min-partitions", type=int)
    p.add_argument("--quarantine", action="store_true",
                   help="set malformed lines aside instead of failing the batch")
    return p


_LOGGERS: dict[int, BatchTimeLogger] = {}


def _settings(a) -> dict:
    """Job settings: defaults, then the properties file, then every flag given."""
    if a.properties:
        from .properties import job_settings, load_properties
        cfg = job_settings(a.job, load_properties(a.properties))
    else:
        conf = {"region-split": RegionSplitConf(topic_in="region_in", topic_out="region_out"),
                "dedup": DedupConf(topic_out="lte_distinct"), "tap": TapConf()}[a.job]
        cfg = {"conf": conf, "brokers": None, "topics": None, "starting": "latest", "group_id": None,
               "secured": a.job != "dedup"}
    change = {}
    if a.interval:
        change["batch_interval_s"] = a.interval
    if a.job != "tap":
        change |= {"on_malformed": "quarantine"} if a.quarantine else {}
        change |= {"topic_out": a.topic_out} if a.topic_out else {}
    if a.job == "region-split" and a.topic_in:
        change["topic_in"] = a.topic_in
    if a.job == "dedup":
        change |= {"key_index": tuple(int(i) for i in a.key_index.split(","))} if a.key_index else {}
        change |= {"time_index": a.time_index} if a.time_index is not None else {}
        change |= {"separator": a.separator} if a.separator else {}
        change |= {"distinct_by_time": False} if a.any else {}
        change |= {"drop_blank": True} if a.drop_blank else {}
    cfg["conf"] = replace(cfg["conf"], **change)
    given = {"brokers": a.brokers, "topics": a.topics, "starting": a.starting, "group_id": a.group_id,
             "secured": a.secured}
    return cfg | {k: v for k, v in given.items() if v is not None}


def main(argv=None, spark: SparkSession | None = None) -> None:
    a = _parser().parse_args(argv)
    cfg = _settings(a)
    if a.in_path is None and not cfg["brokers"]:
        raise SystemExit("give --brokers/--topics (Kafka), --properties, or --in-path (landed record files)")
    spark = spark or SparkSession.builder.appName(f"sigshape-{a.job}").getOrCreate()
    for key, value in JOB_CONF.items():
        spark.conf.set(key, value)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    if id(spark) not in _LOGGERS:                       # per-batch rows and elapsed seconds
        _LOGGERS[id(spark)] = BatchTimeLogger()
        spark.streams.addListener(_LOGGERS[id(spark)])
    ends = None
    if a.in_path is None:
        given = a.starting_offsets_json
        if a.from_positions:
            if a.job != "dedup":
                raise SystemExit("--from-positions: only the dedup job stores positions")
            name = _job_name("dedup", a.name, cfg["topics"] or "")
            given = PositionStore(job_path(spark, f"{name}-positions")).starting_offsets(spark)
        ends = KafkaEnds(cfg["brokers"], cfg["topics"] or "", cfg["secured"], cfg["starting"],
                         given, cfg["group_id"], fail_on_data_loss=not a.allow_data_loss,
                         max_offsets_per_trigger=a.max_offsets_per_trigger,
                         min_partitions=a.min_partitions)
    common = dict(ends=ends, in_path=a.in_path, out_path=a.out_path, available_now=a.available_now,
                  in_format=a.in_format)
    if a.name:
        common["name"] = a.name
    if a.job == "region-split":
        q = region_split_job(spark, cfg["conf"], **common)
    elif a.job == "dedup":
        q = dedup_job(spark, cfg["conf"], **common)
    else:
        q = tap_job(spark, cfg["conf"], sink="console" if a.console else "text", **common)
    finish(q)


if __name__ == "__main__":
    main()
