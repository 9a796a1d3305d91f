import pytest

from sigshape.conf import DedupConf
from sigshape.operators.dedup import dedup_any, dedup_latest, dedup_messages, keyed_lines
from conftest import records

CONF = DedupConf(key_index=(0, 4, 5), time_index=3, separator="|")


def line(imsi, t, lac="L", ci="C", extra="x"):
    return f"{imsi}|{extra}|m|{t}|{lac}|{ci}"


@pytest.mark.parametrize("method", ["max_by", "row_number"])
def test_newest_compares_time_as_text(spark, method):
    df = records(spark, [(1, line("a", "9")), (2, line("a", "10"))])
    got = dedup_latest(df, CONF, method).collect()
    assert [r.value for r in got] == [line("a", "9")]


@pytest.mark.parametrize("method", ["max_by", "row_number"])
def test_equal_times_take_greatest_offset(spark, method):
    df = records(spark, [(1, line("a", "5", extra="first")), (2, line("a", "5", extra="second"))])
    assert [r.value for r in dedup_latest(df, CONF, method).collect()] == [line("a", "5", extra="second")]


def test_equal_times_partition_beats_offset(spark):
    df = records(spark, [(9, line("a", "5", extra="p0"), 0, 0), (1, line("a", "5", extra="p1"), 0, 1)])
    assert [r.value for r in dedup_latest(df, CONF).collect()] == [line("a", "5", extra="p1")]


def test_any_takes_lowest_offset(spark):
    df = records(spark, [(2, line("a", "1", extra="b")), (1, line("a", "9", extra="a"))])
    assert [r.value for r in dedup_any(df, CONF).collect()] == [line("a", "9", extra="a")]


def test_composite_key_collides_on_joined_text(spark):
    conf = DedupConf(key_index=(0, 1), time_index=2, separator="|")
    df = records(spark, [(1, "a_b|c|1"), (2, "a|b_c|2")])
    keys = {r.key for r in keyed_lines(df, conf).collect()}
    assert keys == {"a_b_c"}
    assert dedup_latest(df, conf).count() == 1


def test_scope_is_one_batch(spark):
    df = records(spark, [(1, line("a", "1"), 0), (2, line("a", "2"), 1)])
    got = sorted((r.batch_id, r.value) for r in dedup_latest(df, CONF).collect())
    assert got == [(0, line("a", "1")), (1, line("a", "2"))]


def test_blank_lines_fail_unless_dropped(spark):
    df = records(spark, [(1, ""), (2, line("a", "1"))])
    with pytest.raises(Exception, match="fewer than 6 fields"):
        dedup_latest(df, CONF).collect()
    df = records(spark, [(1, None), (2, line("a", "1"))])
    with pytest.raises(Exception, match="fewer than 6 fields"):
        dedup_latest(df, CONF).count()
    conf = DedupConf(drop_blank=True)
    df = records(spark, [(1, ""), (3, None), (2, line("a", "1"))])
    assert dedup_latest(df, conf).count() == 1


def test_short_line_fails_even_when_counted(spark):
    df = records(spark, [(1, "a|b|c")])
    with pytest.raises(Exception, match="fewer than 6 fields"):
        dedup_latest(df, CONF).count()


def test_multichar_escaped_separator(spark):
    conf = DedupConf(key_index=(0,), time_index=1, separator="\\t|")
    df = records(spark, [(1, "k\t|1\t|x"), (2, "k\t|2\t|y")])
    assert [r.value for r in dedup_latest(df, conf).collect()] == ["k\t|2\t|y"]


def test_messages_keep_original_line(spark):
    df = records(spark, [(1, line("a", "1"))])
    m = dedup_messages(df, CONF).collect()[0]
    assert (m.topic, m.key, m.value) == ("lte_distinct", "a_L_C", line("a", "1"))


def test_conf_validation():
    with pytest.raises(ValueError):
        DedupConf(key_index=())
    with pytest.raises(ValueError):
        DedupConf(time_index=-1)
    assert DedupConf(distinct_by_time=False, time_index=-1).min_width == 6


def test_dedup_invariants_on_events(spark):
    from sigshape.sources.testtables import event_records
    from conftest import SF_SMALL
    recs = event_records(spark, SF_SMALL)
    a = dedup_latest(recs, CONF)
    rows = a.collect()
    assert len({(r.batch_id, r.key) for r in rows}) == len(rows)
    values = {r.value for r in recs.select("value").collect()}
    assert all(r.value in values for r in rows)
    b = dedup_latest(recs.repartition(5), CONF, "row_number")
    assert sorted(map(tuple, rows)) == sorted(map(tuple, b.collect()))


from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

ROW = st.tuples(st.integers(0, 2), st.sampled_from(["a", "b", "a_b"]), st.sampled_from(["c", "b_c", "d"]),
                st.text("0123456789", min_size=0, max_size=3), st.integers(0, 2))


@settings(max_examples=10, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(st.lists(ROW, min_size=1, max_size=40))
def test_dedup_matches_python_model(spark, rows):
    conf = DedupConf(key_index=(0, 1), time_index=2, separator="|")
    data, best_latest, best_any = [], {}, {}
    for off, (batch, k1, k2, t, part) in enumerate(rows):
        line = f"{k1}|{k2}|{t}|{off}"
        data.append((off, line, batch, part))
        key = (batch, f"{k1}_{k2}")
        rank = (t, part, off)
        if key not in best_latest or rank > best_latest[key][0]:
            best_latest[key] = (rank, line)
        if key not in best_any or (part, off) < best_any[key][0]:
            best_any[key] = ((part, off), line)
    df = records(spark, data)
    want = sorted((b, k, v[1]) for (b, k), v in best_latest.items())
    for method in ("row_number", "max_by"):
        assert sorted(map(tuple, dedup_latest(df, conf, method).collect())) == want
    want_any = sorted((b, k, v[1]) for (b, k), v in best_any.items())
    for method in ("row_number", "max_by"):
        assert sorted(map(tuple, dedup_any(df, conf, method).collect())) == want_any


def test_job_conf_validation():
    from sigshape.conf import RegionSplitConf
    with pytest.raises(ValueError):
        RegionSplitConf(on_malformed="skip")
    with pytest.raises(ValueError):
        RegionSplitConf(batch_interval_s=0)
    with pytest.raises(ValueError):
        DedupConf(on_malformed="drop")
