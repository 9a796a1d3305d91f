"""Record sources: Kafka topics or landed record tables with the same schema.

A record is what a Kafka consumer sees: ``topic, partition, offset,
timestamp, key, value`` (key/value decoded as strings). Landed tables carry
an extra ``batch_id`` naming the micro-batch the record arrived in; on a
live stream the micro-batch id plays that role.

Bytes that are not UTF-8 are not text: ``decode_records`` checks landed binary
keys and values and fails, repairs or sets such records aside.

Inventory: S1 (record source, decoding), S2 (topic subscribe), S3/S4 (start policy and secured switch in the Kafka options), T1 on tables (``assign_batches``).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timefmt import instant_to_wallclock, wallclock_to_seconds

RECORD_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampNTZType()),   # UTC wall clock
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])
RECORD_COLUMNS = tuple(f.name for f in RECORD_SCHEMA.fields)

#: Records as they are landed undecoded.
RAW_SCHEMA = T.StructType([T.StructField(f.name, T.BinaryType() if f.name in ("key", "value") else f.dataType)
                           for f in RECORD_SCHEMA.fields])
ON_INVALID = ("fail", "quarantine", "replace")

RESET_POLICIES = ("earliest", "latest", "none")


def topic_set(topic_names: str) -> list[str]:
    """Comma list -> distinct topics, in first-seen order.

    Same as ``String.split(",")`` then a set: trailing empty names vanish,
    inner/leading ones stay, nothing is trimmed.
    """
    if "," not in topic_names:
        parts = [topic_names]
    else:
        parts = topic_names.split(",")
        while parts and parts[-1] == "":
            parts.pop()
    return list(dict.fromkeys(parts))


def kafka_options(brokers: str, topics: str | Iterable[str], *, secured: bool = False,
                  service_name: str = "kafka", starting: str = "latest",
                  starting_offsets_json: str | None = None, group_id: str | None = None,
                  extra: dict | None = None) -> dict[str, str]:
    """Option dict for ``format("kafka")`` readers (batch and stream).

    ``starting`` is the reset policy for partitions without a stored
    position. ``"none"`` means: every partition needs an explicit position,
    so ``starting_offsets_json`` is then required. Only the first start of a
    stream uses it; afterwards the checkpoint decides.
    """
    if starting not in RESET_POLICIES:
        raise ValueError(f"starting must be one of {RESET_POLICIES}")
    names = topic_set(topics) if isinstance(topics, str) else list(dict.fromkeys(topics))
    opts = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": ",".join(names),
        "kafka.security.protocol": "SASL_PLAINTEXT" if secured else "PLAINTEXT",
    }
    if secured:
        opts["kafka.sasl.kerberos.service.name"] = service_name
    if starting_offsets_json is not None:
        opts["startingOffsets"] = starting_offsets_json
    elif starting == "none":
        raise ValueError("reset policy 'none' needs explicit starting offsets")
    else:
        opts["startingOffsets"] = starting
    if group_id:
        opts["kafka.group.id"] = group_id
    opts.update(extra or {})
    return opts


def _from_kafka(df: DataFrame) -> DataFrame:
    return df.select(
        "topic", "partition", "offset",
        instant_to_wallclock("timestamp").alias("timestamp"),
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.lit(None).cast("bigint").alias("batch_id"),
    )


def decode_records(raw: DataFrame, on_invalid: str = "fail"):
    """Records from a table with binary ``key`` and ``value`` (``RAW_SCHEMA``).

    A null stays null. Bytes that are not UTF-8: ``"fail"`` raises on the
    first such record, also when only other columns are used; ``"replace"``
    puts U+FFFD for them, as a plain string decoder would; ``"quarantine"``
    returns ``(records, bad)`` with the whole raw record and its ``reason`` in
    ``bad``. A landed table casts binary to text without a look at the bytes,
    so the check has to be asked for.
    """
    if on_invalid not in ON_INVALID:
        raise ValueError(f"on_invalid must be one of {ON_INVALID}")
    text = {c: F.col(c).cast("string") for c in ("key", "value")}
    bad = {c: F.coalesce(~F.is_valid_utf8(t), F.lit(False)) for c, t in text.items()}

    def decoded(df: DataFrame) -> DataFrame:
        made = {c: F.make_valid_utf8(t) if on_invalid == "replace" else t for c, t in text.items()}
        return df.select(*[made.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in RECORD_SCHEMA.fields])

    if on_invalid == "replace":
        return decoded(raw)
    reason = F.when(bad["key"] & bad["value"], "key and value").when(bad["key"], "key").when(bad["value"], "value")
    if on_invalid == "quarantine":
        return decoded(raw.where(reason.isNull())), raw.where(reason.isNotNull()).withColumn("reason", reason)
    where = F.concat_ws("-", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
    error = F.raise_error(F.concat(F.lit("bytes that are not UTF-8 in "), reason, F.lit(" of "), where)).cast("boolean")
    return decoded(raw.where(F.when(reason.isNotNull(), error).otherwise(F.lit(True))))


def read_records(spark: SparkSession, source: str = "parquet", path: str | None = None,
                 options: dict | None = None, columns: Mapping[str, Column | str] | None = None) -> DataFrame:
    """Read records as a table: a Kafka topic range or a landed record table
    in any file format (parquet, orc, json, ...). Text formats must have been
    written with microsecond timestamps (JSON's default keeps milliseconds).

    ``columns`` reads a table of another layout in place: record field ->
    column or SQL expression over the table's own columns; fields left out
    are null.
    """
    if source == "kafka":
        return _from_kafka(spark.read.format("kafka").options(**(options or {})).load())
    if columns is not None:
        own = spark.read.format(source).options(**(options or {})).load(path)
        given = {k: F.expr(c) if isinstance(c, str) else c for k, c in columns.items()}
        return own.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                            for f in RECORD_SCHEMA.fields])
    reader = spark.read.format(source).schema(RECORD_SCHEMA).options(**(options or {}))
    return reader.load(path).select(*RECORD_COLUMNS)


def stream_records(spark: SparkSession, source: str = "parquet", path: str | None = None,
                   options: dict | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """Read records as a stream (Kafka, or files landed with the record schema)."""
    if source == "kafka":
        return _from_kafka(spark.readStream.format("kafka").options(**(options or {})).load())
    reader = spark.readStream.format(source).schema(RECORD_SCHEMA).options(**(options or {}))
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path).select(*RECORD_COLUMNS)


def subscribe_topics(records: DataFrame, topic_names: str | Iterable[str]) -> DataFrame:
    """Keep records of the subscribed topics (an ``IN`` filter the scan can use)."""
    names = topic_set(topic_names) if isinstance(topic_names, str) else list(dict.fromkeys(topic_names))
    return records.where(F.col("topic").isin(names))


def assign_batches(records: DataFrame, interval_s: int, overwrite: bool = False) -> DataFrame:
    """Set ``batch_id`` from arrival time: ``floor(epoch seconds / interval)``.

    On a live stream the micro-batch is whatever arrived during one trigger
    interval; for a landed table without batch ids this rebuilds the same
    windows from the record timestamp (UTC wall clock). Existing ids are kept
    unless ``overwrite``.
    """
    if interval_s <= 0:
        raise ValueError("interval_s must be positive")
    derived = F.floor(wallclock_to_seconds(F.col("timestamp")) / F.lit(int(interval_s))).cast("bigint")
    batch = derived if overwrite else F.coalesce(F.col("batch_id"), derived)
    return records.withColumn("batch_id", batch)


def clean_values(records: DataFrame, value: str | Column = "value") -> DataFrame:
    """Drop records whose value is null or empty; whitespace-only lines stay."""
    v = F.col(value) if isinstance(value, str) else value
    return records.where(v.isNotNull() & (v != ""))
