"""Named queries: one per operator of the inventory, each ``(spark, sf_dir)
-> DataFrame`` over records that Spark derives from the test tables.

Column names equal those of the oracle SQL in :mod:`sigshape.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..conf import WIDE_LAYOUT, DedupConf, RegionSplitConf
from ..functions.split import decode_escapes, split_list_cell
from ..functions.timefmt import (DEFAULT_PATTERN, TIME_PATTERN, epoch_ms_to_text, text_to_epoch_ms,
                                 wallclock_to_ms, wallclock_to_text)
from ..operators import (clean_records, dedup_any, dedup_latest, dedup_messages, keyed_lines,
                         parallel_explode, project_signal, region_fanout, region_in_messages,
                         region_in_rows, region_out_messages, region_out_rows, require_width,
                         tap_records, with_fields)
from ..session import remove_scratch, scratch_path, shuffles_removed
from ..sources.sinks import (MESSAGE_ID, PLACE, file_options, land_by_partition, message_id, settle_resent,
                             write_messages)
from ..sources.offsets import (PositionStore, footer_bounds, offset_bounds, offset_gaps, offset_resolve,
                               positions_frame, replay_from_offsets, start_position)
from ..sources.records import decode_records, read_records, subscribe_topics
from ..sources.testtables import (dense_records, event_columns, event_field_records, event_records,
                                  raw_event_records, table, tied_records, wide_signal_records)
from ..streaming.runners import (dedup_writer, records_writer, region_split_writer, run_dedup,
                                 run_landed, tap_writer)

# Fixed query parameters.
SPLIT_CONF = RegionSplitConf(topic_in="region_in", topic_out="region_out")
DEDUP_CONF = DedupConf()                       # IMSI|IMEI|MSISDN|BTIME|LAC|CI, key 0,4,5, time 3
TIED_CONF = DedupConf(key_index=(0, 5))        # user and user mod 7: the topic is not in the key
TOPIC_LIST = "click,view,click,,purchase,"     # duplicates, an empty and a trailing name
LITERAL_SEP_TEXT = "\\t|"                      # configuration text: tab then pipe
TOPICS = ("click", "error", "purchase", "signup", "view")
CUR_BY_PARTITION = {0: 5, 1: 600, 2: 10**9, 3: 1500}
STORED_POSITIONS = [(t, p, c) for t in TOPICS for p, c in CUR_BY_PARTITION.items()]
COMMITTED_SUBSET = [x for x in STORED_POSITIONS if x[1] in (0, 1)]

Query = Callable[[SparkSession, str], DataFrame]


def _wide(spark, d):
    return wide_signal_records(spark, d)


def _whole(spark, d):
    """Wide lines with an order's whole list, however long, in one line."""
    return wide_signal_records(spark, d, whole=True)


def _events(spark, d, **kw):
    return event_records(spark, d, **kw)


def _posexplode_fields(records: DataFrame, sep: str, literal: bool) -> DataFrame:
    return with_fields(records, sep, literal=literal).select(
        "offset", F.posexplode("fields").alias("pos", "field"))


# ------------------------------------------------------------------ queries

def q_region_in_rows(spark, d):
    return region_in_rows(_wide(spark, d))


def q_region_in_messages(spark, d):
    return region_in_messages(_wide(spark, d), SPLIT_CONF)


def q_region_out_rows(spark, d):
    return region_out_rows(_wide(spark, d))


def q_region_out_messages(spark, d):
    return region_out_messages(_wide(spark, d), SPLIT_CONF)


def q_region_fanout(spark, d):
    return region_fanout(_wide(spark, d), SPLIT_CONF)


def q_parallel_explode(spark, d):
    """Driver = the half-length list in field 26; companions are longer."""
    df = with_fields(clean_records(_whole(spark, d)))
    f = F.col("fields")
    return parallel_explode(
        df, split_list_cell(f[26]),
        {"in_time": split_list_cell(f[WIDE_LAYOUT["curr_region_intime"]]),
         "in_dt": split_list_cell(f[WIDE_LAYOUT["out_region_in_dt"]])},
        keep=("offset",), pos="pos", elem="region")


def q_dedup_latest(spark, d):
    return dedup_latest(_events(spark, d), DEDUP_CONF, "row_number")


def q_dedup_latest_max_by(spark, d):
    return dedup_latest(_events(spark, d), DEDUP_CONF, "max_by")


def q_dedup_any(spark, d):
    return dedup_any(_events(spark, d), DEDUP_CONF)


def q_dedup_messages(spark, d):
    return dedup_messages(_events(spark, d), DEDUP_CONF)


def q_composite_key(spark, d):
    return keyed_lines(_events(spark, d), DEDUP_CONF).select("offset", "key")


def q_split_fields_csv(spark, d):
    return _posexplode_fields(event_field_records(spark, d, ","), ",", literal=False)


def q_split_fields_literal(spark, d):
    sep = decode_escapes(LITERAL_SEP_TEXT)
    return _posexplode_fields(event_field_records(spark, d, sep), sep, literal=True)


def q_project_signal(spark, d):
    return project_signal(_whole(spark, d), keep=("offset",))


def q_split_list_cell(spark, d):
    """Region list cell with a leading separator (order key mod 5 = 0) and
    0-2 trailing separators (order key mod 3) added."""
    df = with_fields(clean_records(_whole(spark, d)))
    o = F.col("offset")
    cell = F.concat(F.when(o % 5 == 0, F.lit("|")).otherwise(F.lit("")),
                    F.col("fields")[WIDE_LAYOUT["region_code"]],
                    F.repeat(F.lit("|"), (o % 3).cast("int")))
    return df.select("offset", F.posexplode(split_list_cell(cell)).alias("pos", "elem"))


def q_clean_records(spark, d):
    return clean_records(_events(spark, d, blanks=True)).select("partition", "offset", "value")


def q_malformed_rows(spark, d):
    df = with_fields(_events(spark, d, truncate_every=17), decode_escapes(DEDUP_CONF.separator),
                     literal=True)
    _, bad = require_width(df, DEDUP_CONF.min_width, on_malformed="quarantine")
    return bad.select("partition", "offset", "value", "n_fields")


def q_subscribe_topics(spark, d):
    return subscribe_topics(_events(spark, d), TOPIC_LIST).select("topic", "partition", "offset", "value")


def q_read_records(spark, d):
    """The events table, read in place as records."""
    return read_records(spark, "parquet", f"{d.rstrip('/')}/events.parquet", columns=event_columns())


def q_start_position(spark, d):
    bounds = offset_bounds(_events(spark, d))
    return start_position(bounds, positions_frame(spark, COMMITTED_SUBSET), reset="earliest")


def q_offset_bounds(spark, d):
    return offset_bounds(_events(spark, d))


def q_offset_resolve(spark, d):
    return offset_resolve(offset_bounds(_events(spark, d)), positions_frame(spark, STORED_POSITIONS))


def _replay(spark, d, positions, reset):
    out = replay_from_offsets(_events(spark, d), positions_frame(spark, positions), reset=reset)
    return out.select("topic", "partition", "offset", "value")


def q_replay_from_offsets(spark, d):
    return _replay(spark, d, STORED_POSITIONS, "none")


def q_replay_earliest(spark, d):
    """Partitions 2 and 3 have no stored position: replayed whole."""
    return _replay(spark, d, COMMITTED_SUBSET, "earliest")


def q_replay_latest(spark, d):
    """Partitions 2 and 3 have no stored position: skipped."""
    return _replay(spark, d, COMMITTED_SUBSET, "latest")


def q_tap_records(spark, d):
    return tap_records(_events(spark, d))


def q_epoch_ms_to_text(spark, d):
    ev = table(spark, d, "events").select("event_id", wallclock_to_ms(F.col("ts")).alias("epoch_ms"))
    return ev.select("event_id", "epoch_ms", epoch_ms_to_text("epoch_ms").alias("text"))


def q_epoch_ms_to_text_pattern(spark, d):
    ev = table(spark, d, "events").select("event_id", wallclock_to_ms(F.col("ts")).alias("epoch_ms"))
    return ev.select("event_id", "epoch_ms", epoch_ms_to_text("epoch_ms", TIME_PATTERN).alias("text"))


def q_text_to_epoch_ms(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", wallclock_to_text("o_orderdate", DEFAULT_PATTERN).alias("text"))
    return o.select("o_orderkey", "text", text_to_epoch_ms("text").alias("epoch_ms"))


def q_text_to_epoch_ms_pattern(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", wallclock_to_text("o_orderdate", "yyyyMMdd").alias("text"))
    return o.select("o_orderkey", "text", text_to_epoch_ms("text", "yyyyMMdd").alias("epoch_ms"))


def q_stream_read_records(spark, d):
    return spark.read.parquet(run_landed(spark, _events(spark, d), "stream-records", records_writer))


def q_stream_region_fanout(spark, d):
    out = run_landed(spark, _wide(spark, d), "stream-fanout",
                     lambda s, path: region_split_writer(s, path, SPLIT_CONF))
    return spark.read.parquet(out).select("topic", "key", "value")


def q_stream_dedup_latest(spark, d):
    return run_dedup(spark, _events(spark, d), DEDUP_CONF, name="stream-dedup")[0]


def q_stream_dedup_any(spark, d):
    conf = replace(DEDUP_CONF, distinct_by_time=False)
    return run_dedup(spark, _events(spark, d), conf, name="stream-dedup-any")[0]


def q_stream_tap(spark, d):
    out = run_landed(spark, _events(spark, d), "stream-tap", tap_writer)
    return spark.read.parquet(out).select("partition", "offset", "line")


def q_batch_metrics(spark, d):
    """Records read and lines kept by every micro-batch, from the stream's own
    progress rows; ``timed`` says that the batch's seconds were measured."""
    rows = run_dedup(spark, _events(spark, d), DEDUP_CONF, name="stream-metrics")[1]
    one_batch = F.col("first_batch_id") == F.col("last_batch_id")
    return rows.select(F.col("last_batch_id").alias("batch_id"), "rows_in", "rows_out",
                       (one_batch & (F.col("seconds") > 0)).alias("timed"))


def _named_fanout(records):
    """Fan-out messages with the ids of their places."""
    placed = region_fanout(records.withColumnRenamed("topic", PLACE[0]), SPLIT_CONF, keep=PLACE, seq="seq")
    return placed.select("topic", "key", "value", message_id(*PLACE, "seq").alias(MESSAGE_ID))


def q_sink_resent(spark, d):
    """Fan-out messages of which a third are sent again, as after a batch that
    was replayed; the reader keeps one of each id. The lines are landed once,
    each send reads and splits them (a replay reads its source again), and
    after both they go. Of the shuffles, those of one step, or of one slice of
    ids, are on disk at once."""
    source, path = scratch_path(spark, "sink-source"), scratch_path(spark, "sink-resent")
    with shuffles_removed(spark):
        _wide(spark, d).write.options(**file_options("parquet")).parquet(source)
    messages = _named_fanout(read_records(spark, "parquet", source))
    write_messages(messages, "parquet", path)
    write_messages(messages.where(F.pmod(F.xxhash64(MESSAGE_ID), F.lit(3)) == 0), "parquet", path)
    remove_scratch(spark, source)
    return settle_resent(spark.read.parquet(path))


def q_fanout_order(spark, d):
    """Per line, from what the sink has: messages of either topic, and whether
    every current-region one stands before every left-region one."""
    path = scratch_path(spark, "fanout-order")
    write_messages(_named_fanout(_wide(spark, d)), "parquet", path)
    place = F.split(MESSAGE_ID, "/")
    sent = spark.read.parquet(path).select("topic", place[1].cast("int").alias("partition"), place[2].cast("bigint").alias("offset"),
                                           place[3].cast("int").alias("seq"))
    current = F.col("topic") == SPLIT_CONF.topic_in
    return sent.groupBy("partition", "offset").agg(
        F.count_if(current).alias("n_current"), F.count_if(~current).alias("n_left"),
        (F.max(F.when(current, F.col("seq"))) < F.min(F.when(~current, F.col("seq")))).alias("in_order"))


def q_replay_from_stored(spark, d):
    """A stream reads all batches but the newest and stores its positions;
    the whole table is then replayed from there."""
    events = _events(spark, d)
    newest = events.agg(F.max("batch_id")).first()[0]
    store = PositionStore(scratch_path(spark, "stored-positions"))
    run_landed(spark, events.where(F.col("batch_id") < newest), "stream-stored", lambda s, path: dedup_writer(
        s, path, DEDUP_CONF, positions=store)[0])
    out = replay_from_offsets(events, store.read(spark), reset="earliest")
    return out.select("topic", "partition", "offset", "value")


def q_footer_bounds(spark, d):
    """Offset bounds of a landed table, from its file footers."""
    path = scratch_path(spark, "by-partition")
    land_by_partition(_events(spark, d), path)
    return footer_bounds(spark, path)


def q_offset_gaps(spark, d):
    return offset_gaps(dense_records(spark, d))


def q_decode_records(spark, d):
    """Binary records whose key and value are both UTF-8."""
    good, _ = decode_records(raw_event_records(spark, d), "quarantine")
    return good.select("topic", "partition", "offset", "key", "value")


def q_undecodable_records(spark, d):
    _, bad = decode_records(raw_event_records(spark, d), "quarantine")
    return bad.select("topic", "partition", "offset", F.hex("key").alias("key_hex"), F.hex("value").alias("value_hex"), "reason")


def q_text_to_epoch_ms_null(spark, d):
    """Order dates as text, every seventh with a month that is none."""
    day = wallclock_to_text("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    bad = F.concat(F.left(day, F.lit(5)), F.lit("13"), F.substring(day, 8, 12))
    o = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 7 == 0, bad).otherwise(day).alias("text"))
    return o.select("o_orderkey", "text", text_to_epoch_ms("text", on_error="null").alias("epoch_ms"))


def q_text_to_epoch_ms_lenient(spark, d):
    """Order dates whose months, days, hours, minutes and seconds run over, or
    below one, with text after every third."""
    k, t = F.col("o_orderkey"), F.col("o_orderdate")
    text = F.concat(
        F.year(t).cast("string"), F.lit("-"), (F.month(t) + k % 30 - 10).cast("string"), F.lit("-"),
        (F.dayofmonth(t) + k % 50 - 25).cast("string"), F.lit(" "), (k % 50).cast("string"), F.lit(":"),
        (k % 90).cast("string"), F.lit(":"), (k % 100).cast("string"), F.when(k % 3 == 0, " and more").otherwise(""))
    o = table(spark, d, "orders").select("o_orderkey", text.alias("text"))
    return o.select("o_orderkey", "text", text_to_epoch_ms("text", on_error="null", lenient=True).alias("epoch_ms"))


def q_sink_messages(spark, d):
    """Fan-out messages sent through the message sink, and read back."""
    path = scratch_path(spark, "sink-messages")
    write_messages(region_fanout(_wide(spark, d), SPLIT_CONF), "json", path, {"compression": "gzip"}, mode="overwrite")
    return spark.read.schema("key string, value string, topic string").json(path).select("topic", "key", "value")


def q_dedup_latest_tied_topics(spark, d):
    """Key without the topic, records tied on (time, partition, offset)."""
    return dedup_latest(tied_records(spark, d), TIED_CONF)


def q_dedup_latest_max_by_tied_topics(spark, d):
    return dedup_latest(tied_records(spark, d), TIED_CONF, "max_by")


def q_dedup_any_tied_topics(spark, d):
    return dedup_any(tied_records(spark, d), TIED_CONF)


QUERIES: dict[str, Query] = {
    "region_in_rows": q_region_in_rows,
    "region_in_messages": q_region_in_messages,
    "region_out_rows": q_region_out_rows,
    "region_out_messages": q_region_out_messages,
    "region_fanout": q_region_fanout,
    "parallel_explode": q_parallel_explode,
    "dedup_latest": q_dedup_latest,
    "dedup_latest_max_by": q_dedup_latest_max_by,
    "dedup_any": q_dedup_any,
    "dedup_messages": q_dedup_messages,
    "composite_key": q_composite_key,
    "split_fields_csv": q_split_fields_csv,
    "split_fields_literal": q_split_fields_literal,
    "project_signal": q_project_signal,
    "split_list_cell": q_split_list_cell,
    "clean_records": q_clean_records,
    "malformed_rows": q_malformed_rows,
    "subscribe_topics": q_subscribe_topics,
    "read_records": q_read_records,
    "start_position": q_start_position,
    "offset_bounds": q_offset_bounds,
    "offset_resolve": q_offset_resolve,
    "replay_from_offsets": q_replay_from_offsets,
    "tap_records": q_tap_records,
    "epoch_ms_to_text": q_epoch_ms_to_text,
    "text_to_epoch_ms": q_text_to_epoch_ms,
    "epoch_ms_to_text_pattern": q_epoch_ms_to_text_pattern,
    "text_to_epoch_ms_pattern": q_text_to_epoch_ms_pattern,
    "stream_read_records": q_stream_read_records,
    "stream_region_fanout": q_stream_region_fanout,
    "stream_dedup_latest": q_stream_dedup_latest,
    "stream_tap": q_stream_tap,
    "batch_metrics": q_batch_metrics,
    "stream_dedup_any": q_stream_dedup_any,
    "sink_messages": q_sink_messages,
    "replay_earliest": q_replay_earliest,
    "replay_latest": q_replay_latest,
    "dedup_latest_tied_topics": q_dedup_latest_tied_topics,
    "dedup_latest_max_by_tied_topics": q_dedup_latest_max_by_tied_topics,
    "dedup_any_tied_topics": q_dedup_any_tied_topics,
    "sink_resent": q_sink_resent,
    "fanout_order": q_fanout_order,
    "replay_from_stored": q_replay_from_stored,
    "footer_bounds": q_footer_bounds,
    "offset_gaps": q_offset_gaps,
    "decode_records": q_decode_records,
    "undecodable_records": q_undecodable_records,
    "text_to_epoch_ms_null": q_text_to_epoch_ms_null,
    "text_to_epoch_ms_lenient": q_text_to_epoch_ms_lenient,
}
