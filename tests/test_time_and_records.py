import pytest
from pyspark.sql import functions as F

from sigshape.functions.timefmt import epoch_ms_to_text, text_to_epoch_ms
from sigshape.operators.tap import tap_records
from sigshape.sources.records import kafka_options, read_records, subscribe_topics
from conftest import records


def test_epoch_ms_round_trip(spark):
    df = spark.createDataFrame([(1704067207179,), (0,), (-1,)], "ms bigint")
    got = [tuple(r) for r in df.select(epoch_ms_to_text("ms").alias("a"),
                                        epoch_ms_to_text("ms", "HH:mm:ss").alias("b")).collect()]
    assert got == [("2024-01-01 00:00:07", "00:00:07"), ("1970-01-01 00:00:00", "00:00:00"),
                   ("1969-12-31 23:59:59", "23:59:59")]
    t = spark.createDataFrame([("2024-01-01 00:00:07",)], "t string")
    assert t.select(text_to_epoch_ms("t").alias("x")).first().x == 1704067207000


def test_time_zone_argument(spark):
    df = spark.createDataFrame([(0,)], "ms bigint")
    assert df.select(epoch_ms_to_text("ms", tz="Asia/Tokyo").alias("a")).first().a == "1970-01-01 09:00:00"
    t = spark.createDataFrame([("1970-01-01 09:00:00",)], "t string")
    assert t.select(text_to_epoch_ms("t", tz="Asia/Tokyo").alias("x")).first().x == 0


def test_strict_parse_raises_and_lenient_gives_null(spark):
    t = spark.createDataFrame([("2024-13-01 00:00:00",)], "t string")
    with pytest.raises(Exception):
        t.select(text_to_epoch_ms("t").alias("x")).collect()
    assert t.select(text_to_epoch_ms("t", on_error="null").alias("x")).first().x is None


def test_kafka_options():
    o = kafka_options("b1:9092,b2:9092", "a,b,a", secured=True, starting="earliest", group_id="g")
    assert o["subscribe"] == "a,b" and o["kafka.security.protocol"] == "SASL_PLAINTEXT"
    assert o["kafka.sasl.kerberos.service.name"] == "kafka" and o["startingOffsets"] == "earliest"
    assert o["kafka.group.id"] == "g"
    p = kafka_options("b", ["x"])
    assert p["kafka.security.protocol"] == "PLAINTEXT" and "kafka.sasl.kerberos.service.name" not in p
    with pytest.raises(ValueError):
        kafka_options("b", "x", starting="none")
    assert kafka_options("b", "x", starting="none", starting_offsets_json='{"x":{"0":5}}')["startingOffsets"]


def test_subscribe_and_tap(spark):
    df = records(spark, [(1, "v1"), (2, None)], topic="x")
    assert subscribe_topics(df, "y,x,").count() == 2
    assert subscribe_topics(df, "y").count() == 0
    got = [r.line for r in tap_records(df).orderBy("offset").collect()]
    assert got == ["key:nullvalue:v1", "key:nullvalue:null"]


def test_read_records_from_landed_table(spark, tmp_path):
    df = records(spark, [(1, "v1"), (2, "v2")])
    df.write.parquet(str(tmp_path / "r"))
    back = read_records(spark, "parquet", str(tmp_path / "r"))
    assert back.columns == df.columns and back.count() == 2


def test_kafka_format_missing_is_reported(spark):
    with pytest.raises(Exception):
        read_records(spark, "kafka", options=kafka_options("b:1", "t"))


def test_kafka_rows_become_records(spark):
    """Rows shaped like the Kafka source (binary key/value, LTZ timestamp)."""
    import datetime
    from sigshape.sources.records import RECORD_COLUMNS, _from_kafka
    kafka_schema = ("key binary, value binary, topic string, partition int, offset bigint, "
                    "timestamp timestamp, timestampType int")
    ts = datetime.datetime(2024, 1, 1, 0, 0, 7)
    df = spark.createDataFrame([(b"k1", b"a,b", "t", 3, 42, ts, 0), (None, None, "t", 3, 43, ts, 0)],
                               kafka_schema)
    out = _from_kafka(df)
    assert tuple(out.columns) == RECORD_COLUMNS
    rows = out.orderBy("offset").collect()
    assert (rows[0].key, rows[0].value, rows[0].batch_id) == ("k1", "a,b", None)
    assert rows[1].key is None and rows[1].value is None
    assert dict(out.dtypes)["timestamp"] == "timestamp_ntz"


def test_results_do_not_depend_on_session_time_zone(spark):
    from sigshape.sources.testtables import event_records
    from conftest import SF_SMALL
    df = spark.createDataFrame([(1704067207179,)], "ms bigint")

    def snapshot():
        text = df.select(epoch_ms_to_text("ms").alias("t")).first().t
        ms = spark.createDataFrame([(text,)], "t string").select(text_to_epoch_ms("t").alias("x")).first().x
        batches = sorted(r.batch_id for r in event_records(spark, SF_SMALL).select("batch_id").distinct().collect())
        lines = sorted(r.value for r in event_records(spark, SF_SMALL).select("value").collect())
        return text, ms, batches, lines

    before = snapshot()
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("Asia/Kolkata", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert snapshot() == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


# 2024-03-10 02:30 does not exist in New York, 2024-11-03 01:30 exists twice there.
@pytest.mark.parametrize("ms,text", [(1710037800000, "2024-03-10 02:30:00"), (1730597400000, "2024-11-03 01:30:00"),
                                     (-1, "1969-12-31 23:59:59"), (0, "1970-01-01 00:00:00")])
@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "America/Sao_Paulo"])
def test_hours_that_a_zone_skips_or_repeats(spark, zone, ms, text):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        df = spark.createDataFrame([(ms, text)], "ms bigint, t string")
        r = df.select(epoch_ms_to_text("ms").alias("a"), epoch_ms_to_text("ms", "HH:mm:ss").alias("b"),
                      epoch_ms_to_text("ms", "EEE d MMM yy, h:mm a").alias("c"),
                      text_to_epoch_ms("t").alias("d")).first()
        assert (r.a, r.b, r.d) == (text, text[11:], ms // 1000 * 1000)
        import datetime as dt
        t = dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=ms)
        assert r.c == t.strftime("%a ") + str(t.day) + t.strftime(" %b %y, ") + str((t.hour + 11) % 12 + 1) + t.strftime(":%M %p")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_kafka_timestamps_are_utc_wall_clock_in_any_zone(spark):
    from sigshape.sources.records import _from_kafka
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.sql("SELECT CAST(NULL AS BINARY) AS key, CAST('v' AS BINARY) AS value, 't' AS topic, 0 AS partition, "
                       "CAST(1 AS BIGINT) AS offset, timestamp_millis(1710037800123) AS timestamp, 0 AS timestampType")
        assert str(_from_kafka(df).first().timestamp) == "2024-03-10 02:30:00.123000"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_assign_batches_rebuilds_interval_windows(spark):
    from pyspark.sql import functions as F
    from sigshape.sources.records import assign_batches
    from sigshape.sources.testtables import BATCH_SECONDS, event_records
    from conftest import SF_SMALL
    recs = event_records(spark, SF_SMALL)
    rebuilt = assign_batches(recs.withColumn("batch_id", F.lit(None).cast("bigint")), BATCH_SECONDS)
    a = sorted((r.offset, r.batch_id) for r in recs.select("offset", "batch_id").collect())
    b = sorted((r.offset, r.batch_id) for r in rebuilt.select("offset", "batch_id").collect())
    assert a == b
    kept = assign_batches(recs.withColumn("batch_id", F.lit(7).cast("bigint")), 60)
    assert {r.batch_id for r in kept.select("batch_id").collect()} == {7}
    with pytest.raises(ValueError):
        assign_batches(recs, 0)


from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st


@settings(max_examples=8, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-2_208_988_800_000, 4_102_444_800_000), min_size=10, max_size=40))
def test_time_functions_match_python_model(spark, values):
    import datetime as dt
    epoch = dt.datetime(1970, 1, 1)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, ms bigint")
    got = df.select("i", epoch_ms_to_text("ms").alias("a"), epoch_ms_to_text("ms", "HH:mm:ss").alias("b"),
                    text_to_epoch_ms(epoch_ms_to_text("ms")).alias("c")).orderBy("i").collect()
    for v, r in zip(values, got):
        t = epoch + dt.timedelta(milliseconds=v)
        assert r.a == t.strftime("%Y-%m-%d %H:%M:%S")
        assert r.b == t.strftime("%H:%M:%S")
        assert r.c == (v // 1000) * 1000            # seconds pattern: milliseconds truncated (floored)


@pytest.mark.parametrize("fmt", ["json", "orc"])
def test_records_landed_in_other_formats(spark, tmp_path, fmt):
    from sigshape.operators.dedup import dedup_latest
    from sigshape.sources.testtables import event_records
    from conftest import SF_SMALL
    recs = event_records(spark, SF_SMALL)
    path = str(tmp_path / fmt)
    writer = recs.write.format(fmt)
    if fmt == "json":       # the JSON writer keeps milliseconds unless told otherwise
        writer = writer.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    writer.save(path)
    back = read_records(spark, fmt, path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, recs.collect()))
    assert sorted(map(tuple, dedup_latest(back).collect())) == sorted(map(tuple, dedup_latest(recs).collect()))


# 02:30 on 2024-03-10 does not exist in New York, 01:30 on 2024-11-03 exists twice.
@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "America/Sao_Paulo"])
def test_all_parsers_agree_in_every_zone(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    texts = ["2024-03-10 02:30:00", "2024-11-03 01:30:00", "2024-07-01 12:00:00", "1969-12-31 23:59:59"]
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        for r in df.select("t", text_to_epoch_ms("t").alias("a"), text_to_epoch_ms("t", on_error="null").alias("b"),
                           text_to_epoch_ms("t", lenient=True).alias("c")).collect():
            import datetime as dt
            want = int((dt.datetime.strptime(r.t, "%Y-%m-%d %H:%M:%S") - dt.datetime(1970, 1, 1)).total_seconds()) * 1000
            assert (r.a, r.b, r.c) == (want, want, want)
        bad = spark.createDataFrame([("2024-13-01 00:00:00",), ("",), (None,), ("x",)], "t string")
        assert [r.x for r in bad.select(text_to_epoch_ms("t", on_error="null").alias("x")).collect()] == [None] * 4
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def _rolled(y, m, d, H=0, M=0, S=0):
    import datetime as dt
    first = dt.datetime(y + (m - 1) // 12, (m - 1) % 12 + 1, 1)
    return int((first + dt.timedelta(days=d - 1, hours=H, minutes=M, seconds=S) - dt.datetime(1970, 1, 1)).total_seconds()) * 1000


@pytest.mark.parametrize("text,pattern,want", [
    ("2024-13-01 00:00:00", "yyyy-MM-dd HH:mm:ss", _rolled(2024, 13, 1)),
    ("2024-02-30 25:61:61", "yyyy-MM-dd HH:mm:ss", _rolled(2024, 2, 30, 25, 61, 61)),
    ("2024-1-0 0:0:0 trailing text", "yyyy-MM-dd HH:mm:ss", _rolled(2024, 1, 0)),
    ("2024--1--5 -1:0:0", "yyyy-MM-dd HH:mm:ss", _rolled(2024, -1, -5, -1)),
    ("20241301", "yyyyMMdd", _rolled(2024, 13, 1)), ("202413014", "yyyyMMdd", _rolled(2024, 13, 14)),
    ("2024-02-30", "yyyy-MM-dd HH:mm:ss", None), ("x2024-02-30", "yyyy-MM-dd", None), ("", "yyyy", None), (None, "yyyy", None),
    ("90:00:00", "HH:mm:ss", _rolled(1970, 1, 1, 90)), ("99999999999-1-1", "yyyy-MM-dd", None), ("123456789-1-1", "yyyy-MM-dd", None)])
def test_lenient_parsing_rolls_over(spark, text, pattern, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(text_to_epoch_ms("t", pattern, on_error="null", lenient=True).alias("x")).first().x == want
    if want is None and text is not None:
        with pytest.raises(Exception, match="unparseable"):
            df.select(text_to_epoch_ms("t", pattern, lenient=True).alias("x")).collect()


def test_lenient_parsing_refuses_named_fields():
    with pytest.raises(ValueError, match="EEE"):
        text_to_epoch_ms("t", "EEE yyyy", lenient=True)


def test_binary_records_are_checked(spark):
    from sigshape.sources.records import RAW_SCHEMA, RECORD_COLUMNS, decode_records
    good, cut, stray = "né|1".encode(), "né".encode()[:-1], b"\xff"
    rows = [("t", 0, i, None, k, v, 0) for i, (k, v) in enumerate([(None, good), (b"k", cut), (stray, b""), (stray, cut), (b"k", None)])]
    raw = spark.createDataFrame(rows, RAW_SCHEMA)
    ok, bad = decode_records(raw, "quarantine")
    assert tuple(ok.columns) == RECORD_COLUMNS
    assert sorted((r.offset, r.key, r.value) for r in ok.collect()) == [(0, None, "né|1"), (4, "k", None)]
    assert sorted((r.offset, r.reason, bytes(r.value)) for r in bad.collect()) == [
        (1, "value", cut), (2, "key", b""), (3, "key and value", cut)]
    mended = {r.offset: (r.key, r.value) for r in decode_records(raw, "replace").collect()}
    assert mended[1] == ("k", "n\ufffd") and mended[2] == ("\ufffd", "") and mended[0] == (None, "né|1")
    for use in (lambda df: df.count(), lambda df: df.select("offset").collect()):
        with pytest.raises(Exception, match="not UTF-8 in value of t-0-1"):
            use(decode_records(raw.where("offset in (0, 1)")))
    with pytest.raises(ValueError):
        decode_records(raw, "drop")
