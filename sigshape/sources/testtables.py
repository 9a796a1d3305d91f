"""Record tables built from the relational test tables.

The operators read message records; the test data is relational. These
encoders derive records from it with Spark, so every query's work grows
with the tables:

* wide signalling lines: one per order and part block, or one per whole order
  (``orders`` LEFT JOIN lists of its ``lineitem`` values), 34 comma-separated fields, seven of them
  ``|``-joined parallel lists;
* dedup lines: one per ``events`` row, ``IMSI|IMEI|MSISDN|BTIME|LAC|CI``;
* field lines: ``events`` columns joined with a given separator, with blank
  middle and trailing fields.

Scale notes: the only shuffles are the list grouping, of the raw columns, and
the join back to ``orders``, of the finished list cells; ``lineitem`` is read
once. The texts of an item are formatted between the first shuffle and the
grouping, in one generated projection, and a line is built once: it
is a generator's output, below which no filter on it can be pushed. A list's
unit is (order, block of part keys), the rows' own columns: an order that
holds a third of all lines falls into as many units as it has part blocks, by
the same rule as every other order. Whole lists are one value each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefmt import wallclock_to_seconds, wallclock_to_text
from .records import RECORD_COLUMNS

PART_BLOCK = 100_000             # part keys that share a line of one order
OFFSET_STEP = 1 << 40            # between the offsets of one order's lines
BATCH_SECONDS = 864_000          # 10-day batches for the events-based records

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


# ------------------------------------------------------------ wide signalling lines

def order_lists(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    """``(l_orderkey, unit, elems)``: sorted item structs per order and part
    block (``unit`` = part key div ``PART_BLOCK``); ``whole``: per order
    (``unit`` = 0), grouped by the key of the later join.

    An item is its sort key (its first fields: ``sort_array`` orders by them)
    and the text of its cells. Rows are shuffled as they are: a map-side
    partial collect_list shrinks nothing, it only adds a sort. The number of
    parts is named, so that they are not merged by their compressed size: the
    items of a part are several times that, and a merged part would spill.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.floor(F.col("l_partkey") / F.lit(PART_BLOCK)).cast("bigint").alias("unit"),
        "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag", "l_linestatus")
    shipped = wallclock_to_text("l_shipdate", "yyyyMMddHHmmss").alias("shipped")
    item = F.struct(
        "l_linenumber", "l_partkey", "l_suppkey", "shipped", "l_returnflag", "l_linestatus",
        _s("l_partkey").alias("part"), flag_text(F.col("l_returnflag")).alias("flag"), _s("l_suppkey").alias("supp"),
        F.left("shipped", F.lit(8)).alias("day"), _s("l_linenumber").alias("number"))
    if whole:
        return (items.drop("unit").repartition(parts, "l_orderkey").select("*", shipped).select("l_orderkey", item.alias("e"))
                .groupBy("l_orderkey").agg(F.sort_array(F.collect_list("e")).alias("elems"))
                .select("l_orderkey", F.lit(0).cast("bigint").alias("unit"), "elems"))
    return (items.repartition(parts, "l_orderkey", "unit").select("*", shipped).select("l_orderkey", "unit", item.alias("e"))
            .groupBy("l_orderkey", "unit").agg(F.sort_array(F.collect_list("e")).alias("elems")))


def _cell(elems: Column, name: str) -> Column:
    """One list cell: a field of each element, ``|``-joined."""
    return F.array_join(elems[name], "|")


def list_cells(lists: DataFrame) -> DataFrame:
    """``order_lists`` as the text of a line's cells: the join with ``orders``
    shuffles the text, a third of the items' size."""
    elems = F.col("elems")
    half = F.slice(elems, 1, ((F.size(elems) + 1) / 2).cast("int"))
    last = ("shipped", "flag", "supp", "day", "number", "l_linestatus")
    return lists.select("l_orderkey", "unit", _cell(elems, "part").alias("part"), _cell(half, "part").alias("half"),
                        F.concat_ws(",", *[_cell(elems, n) for n in last]).alias("last"))


def flag_text(returnflag: Column) -> Column:
    """Region in/out flag derived from the return flag: 0 unchanged, 1 in, 9 unknown."""
    return F.when(returnflag == "A", "0").when(returnflag == "R", "1").otherwise("9")


def wide_line_fields(o: dict[str, Column], cells: dict[str, Column], unit: Column) -> list[Column]:
    """The 34 fields of one wide line, by position (the last six as one text);
    list cells are blank without a list."""
    blank = F.lit("")
    return [
        _s(o["custkey"]),                                          # 0 imsi
        wallclock_to_text(o["orderdate"], "yyyyMMddHHmmss"),       # 1 timestamp
        _s(o["orderkey"]), o["status"], o["priority"],             # 2-4 filler
        blank, _s(unit), blank, blank,                             # 5-8 filler
        F.coalesce(cells["part"], blank),                          # 9 region_code list
        o["status"],                                               # 10 city_code
        o["priority"],                                             # 11 county_code
        _s(o["custkey"] % 31),                                     # 12 usr_prov_code
        _s(o["custkey"] % 97),                                     # 13 usr_city_code
        _s(o["orderkey"] % 89),                                    # 14 usr_county_code
        F.when(o["custkey"] % 2 == 0, "M").otherwise("F"),         # 15 sex
        _s(o["custkey"] % 7),                                      # 16 age_level
        _s(o["orderkey"] % 5),                                     # 17 arpu_level
        blank, F.lit("0"), blank, blank, blank, blank,             # 18-23 filler
        _s(o["orderkey"] % 100),                                   # 24 out_city_code
        _s(o["orderkey"] % 1000),                                  # 25 out_county_code
        F.coalesce(cells["half"], blank),                          # 26 first half of region list
        blank,                                                     # 27 filler
        # 28 in-time list, 29 in/out flag list, 30 out_region list, 31 out in-date list, 32 out out-date list, 33 stay list
        F.coalesce(cells["last"], F.lit(",,,,,")),
    ]


def wide_signal_records(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    """Record table of wide signalling lines, one per order and part block;
    ``whole``: one per order, with all its items (such a line has to fit a row).

    topic ``signal``, partition = customer mod 8 (a key-hash style
    assignment), offset = order key + part block * ``OFFSET_STEP``,
    batch_id = order year. An order without lines is one line with blank cells.
    """
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    lists = list_cells(order_lists(spark, sf_dir, whole))
    j = orders.join(lists, orders.o_orderkey == lists.l_orderkey, "left")
    o = {"orderkey": F.col("o_orderkey"), "custkey": F.col("o_custkey"),
         "status": F.col("o_orderstatus"), "priority": F.col("o_orderpriority"),
         "orderdate": F.col("o_orderdate")}
    unit = F.coalesce("unit", F.lit(0))
    cells = {c: F.col(c) for c in ("part", "half", "last")}
    value = F.concat_ws(",", *wide_line_fields(o, cells, unit))
    return j.select(
        F.lit("signal").alias("topic"),
        F.pmod(F.col("o_custkey"), F.lit(8)).cast("int").alias("partition"),
        (F.col("o_orderkey") + unit * F.lit(OFFSET_STEP)).alias("offset"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("timestamp"),
        F.lit(None).cast("string").alias("key"),
        F.inline(F.array(F.struct(value.alias("value")))),
        F.year("o_orderdate").cast("bigint").alias("batch_id"),
    ).select(*RECORD_COLUMNS)


# ------------------------------------------------------------ events-based records

def event_line() -> Column:
    """``IMSI|IMEI|MSISDN|BTIME|LAC|CI`` from an events row: user, event id,
    props, day of ``ts`` (``yyyyMMdd``, so ties happen), event type, user mod 7."""
    return F.concat_ws("|", _s("user_id"), _s("event_id"), F.col("props"),
                       wallclock_to_text("ts", "yyyyMMdd"), F.col("event_type"),
                       _s(F.col("user_id") % 7))


def event_records(spark: SparkSession, sf_dir: str, blanks: bool = False,
                  truncate_every: int | None = None) -> DataFrame:
    """Record table of dedup lines, one per event.

    topic = event type, partition = user mod 4, offset = event id + 100,
    key = user id (null for every 13th event), batch_id = 10-day window.
    ``blanks``: value null / empty / one space for event id mod 10 = 0 / 1 / 2.
    ``truncate_every``: those rows keep only their first three fields.
    """
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    value = event_line()
    if truncate_every:
        short = F.concat_ws("|", _s("user_id"), _s("event_id"), F.col("props"))
        value = F.when(F.col("event_id") % truncate_every == 0, short).otherwise(value)
    if blanks:
        r = F.col("event_id") % 10
        value = (F.when(r == 0, F.lit(None).cast("string")).when(r == 1, F.lit(""))
                 .when(r == 2, F.lit(" ")).otherwise(value))
    return ev.select(
        F.col("event_type").alias("topic"),
        F.pmod(F.col("user_id"), F.lit(4)).cast("int").alias("partition"),
        (F.col("event_id") + 100).alias("offset"),
        F.col("ts").cast("timestamp_ntz").alias("timestamp"),
        F.when(F.col("event_id") % 13 == 0, F.lit(None).cast("string")).otherwise(_s("user_id")).alias("key"),
        value.alias("value"),
        F.floor(wallclock_to_seconds(F.col("ts").cast("timestamp_ntz")) / F.lit(BATCH_SECONDS))
        .cast("bigint").alias("batch_id"),
    ).select(*RECORD_COLUMNS)


def event_field_records(spark: SparkSession, sf_dir: str, sep: str) -> DataFrame:
    """Events as six ``sep``-joined fields with blank middle (id mod 3 = 0)
    and blank trailing (id mod 4 = 0) fields."""
    ev = table(spark, sf_dir, "events")
    fields = [
        _s("event_id"), _s("user_id"), F.col("event_type"),
        F.when(F.col("event_id") % 3 == 0, "").otherwise(F.col("props")),
        wallclock_to_text("ts", "yyyy-MM-dd HH:mm:ss"),
        F.when(F.col("event_id") % 4 == 0, "").otherwise(F.col("event_type")),
    ]
    return ev.select(
        F.lit("fields").alias("topic"),
        F.pmod(F.col("user_id"), F.lit(4)).cast("int").alias("partition"),
        (F.col("event_id") + 100).alias("offset"),
        F.col("ts").cast("timestamp_ntz").alias("timestamp"),
        F.lit(None).cast("string").alias("key"),
        F.concat_ws(sep, *fields).alias("value"),
        F.lit(0).cast("bigint").alias("batch_id"),
    )


def tied_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event lines of several topics whose partition, offset and time are
    equal: the first event of each (type, user, day), offset = user * 1000 +
    day of year, topic = event type. Only the topic tells tied records apart."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    day = F.col("ts").cast("date")
    first = (ev.groupBy("event_type", "user_id", day.alias("day"))
             .agg(F.min_by(F.struct("event_id", "ts", "props"), "event_id").alias("e"))
             .select("event_type", "user_id", "day", "e.*"))
    return first.select(
        F.col("event_type").alias("topic"),
        F.pmod(F.col("user_id"), F.lit(4)).cast("int").alias("partition"),
        (F.col("user_id") * 1000 + F.dayofyear("day")).cast("bigint").alias("offset"),
        F.col("ts").cast("timestamp_ntz").alias("timestamp"),
        F.lit(None).cast("string").alias("key"), event_line().alias("value"),
        F.year("day").cast("bigint").alias("batch_id"))


def event_columns() -> dict[str, Column]:
    """Record fields over the ``events`` table's own columns (read in place)."""
    return {
        "topic": F.col("event_type"), "partition": F.pmod(F.col("user_id"), F.lit(4)),
        "offset": F.col("event_id") + 100, "timestamp": F.col("ts"),
        "key": F.when(F.col("event_id") % 13 != 0, _s("user_id")), "value": event_line(),
        "batch_id": F.floor(wallclock_to_seconds(F.col("ts").cast("timestamp_ntz")) / F.lit(BATCH_SECONDS)),
    }


def dense_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event lines whose offsets are dense but for planted holes: partition =
    event id mod 4, offset = event id div 4; missing are the ids of 97 that end a
    hundred or so (id mod 97 < 3), and every thirteenth run of 1,000 ids."""
    ev = table(spark, sf_dir, "events").where((F.col("event_id") % 97 >= 3) & (F.floor(F.col("event_id") / 1000) % 13 != 5))
    return ev.select(
        F.lit("dense").alias("topic"), (F.col("event_id") % 4).cast("int").alias("partition"),
        F.floor(F.col("event_id") / 4).cast("bigint").alias("offset"), F.col("ts").cast("timestamp_ntz").alias("timestamp"),
        F.lit(None).cast("string").alias("key"), event_line().alias("value"), F.lit(0).cast("bigint").alias("batch_id"))


def raw_event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_records`` with binary key and value; planted bytes that are not
    UTF-8: a value cut inside a character (event id mod 19 = 0), a key that is
    one stray byte (mod 23 = 0)."""
    ev = event_records(spark, sf_dir)
    n = F.col("offset") - 100
    value = F.concat(F.col("value").cast("binary"), F.when(n % 19 == 0, F.unhex(F.lit("E282"))).otherwise(F.unhex(F.lit(""))))
    key = F.when(n % 23 == 0, F.unhex(F.lit("FF"))).otherwise(F.col("key").cast("binary"))
    return ev.withColumns({"value": value, "key": key})
