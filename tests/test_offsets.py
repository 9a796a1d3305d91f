import pytest

from sigshape.sources.offsets import (offset_bounds, offset_resolve, positions_frame,
                                      replay_from_offsets, start_position)
from conftest import records


def _recs(spark):
    # partition 0: offsets 10..14; partition 1: offsets 20..21
    rows = [(o, f"v{o}", 0, 0) for o in range(10, 15)] + [(o, f"w{o}", 0, 1) for o in (20, 21)]
    return records(spark, rows)


def test_bounds_latest_is_last_plus_one(spark):
    b = {(r.partition): (r.earliest, r.latest) for r in offset_bounds(_recs(spark)).collect()}
    assert b == {0: (10, 15), 1: (20, 22)}


def test_resolve_clamps_and_reports(spark):
    pos = positions_frame(spark, [("t", 0, 3), ("t", 1, 21), ("t", 0, 99)])
    got = sorted((r.cur, r.start, r.status) for r in offset_resolve(offset_bounds(_recs(spark)), pos).collect())
    assert got == [(3, 10, "below"), (21, 21, "ok"), (99, 15, "above")]


def test_resolve_missing_partition_raises(spark):
    pos = positions_frame(spark, [("t", 7, 3)])
    with pytest.raises(Exception, match="no offsets known"):
        offset_resolve(offset_bounds(_recs(spark)), pos).collect()


def test_start_position_reset_policies(spark):
    b = offset_bounds(_recs(spark))
    committed = positions_frame(spark, [("t", 0, 12)])
    e = {r.partition: (r.cur, r.source) for r in start_position(b, committed, "earliest").collect()}
    assert e == {0: (12, "committed"), 1: (20, "earliest")}
    l_ = {r.partition: (r.cur, r.source) for r in start_position(b, committed, "latest").collect()}
    assert l_ == {0: (12, "committed"), 1: (22, "latest")}
    with pytest.raises(Exception, match="reset policy none"):
        start_position(b, committed, "none").collect()
    with pytest.raises(ValueError):
        start_position(b, committed, "middle")


def test_replay_from_resolved_positions(spark):
    committed = positions_frame(spark, [("t", 0, 13), ("t", 1, 10**9)])
    got = sorted(r.offset for r in replay_from_offsets(_recs(spark), committed, "none").collect())
    assert got == [13, 14]
    committed = positions_frame(spark, [("t", 0, 0)])
    got = sorted(r.offset for r in replay_from_offsets(_recs(spark), committed, "earliest").collect())
    assert got == [10, 11, 12, 13, 14, 20, 21]


def test_replay_equals_clamped_resolution(spark):
    """One-pass replay == filter on the clamped start from offset_resolve."""
    from pyspark.sql import functions as F
    recs = _recs(spark)
    pos = positions_frame(spark, [("t", 0, 3), ("t", 1, 99)])
    res = offset_resolve(offset_bounds(recs), pos).select("topic", "partition", "start")
    want = sorted(r.offset for r in recs.join(res, ["topic", "partition"])
                  .where(F.col("offset") >= F.col("start")).collect())
    got = sorted(r.offset for r in replay_from_offsets(recs, pos, "none").collect())
    assert got == want == [10, 11, 12, 13, 14]


def test_replay_reset_policies(spark):
    recs = _recs(spark)
    only_p0 = positions_frame(spark, [("t", 0, 13)])
    assert sorted(r.offset for r in replay_from_offsets(recs, only_p0, "latest").collect()) == [13, 14]
    assert sorted(r.offset for r in replay_from_offsets(recs, only_p0, "earliest").collect()) == [13, 14, 20, 21]
    with pytest.raises(Exception, match="reset policy none"):
        replay_from_offsets(recs, only_p0, "none").collect()


def test_guards_survive_column_pruning(spark):
    bounds = offset_bounds(_recs(spark))
    unknown = positions_frame(spark, [("t", 0, 3), ("t", 9, 3)])
    with pytest.raises(Exception, match="no offsets known for t-9"):
        offset_resolve(bounds, unknown).select("status").collect()
    with pytest.raises(Exception, match="no offsets known for t-9"):
        offset_resolve(bounds, unknown).count()
    with pytest.raises(Exception, match="no offsets known for stored position t-9"):
        start_position(bounds, unknown, reset="latest").select("source").collect()
    with pytest.raises(Exception, match="no offsets known for t-9"):
        offset_resolve(bounds, unknown).where("start > 0 and latest > 0").collect()
    partial = positions_frame(spark, [("t", 0, 3)])
    with pytest.raises(Exception, match="reset policy none for t-1"):
        start_position(bounds, partial, reset="none").count()
    with pytest.raises(Exception, match="reset policy none for t-1"):
        start_position(bounds, partial, reset="none").select("source").collect()
    with pytest.raises(Exception, match="reset policy none for t-1"):
        replay_from_offsets(_recs(spark), partial, "none").count()


def test_starting_offsets_json_from_resolved(spark):
    import json
    from sigshape.sources.offsets import EARLIEST, resolved_positions, starting_offsets_json
    pos = positions_frame(spark, [("t", 0, 3), ("t", 1, 21)])
    resolved = offset_resolve(offset_bounds(_recs(spark)), pos)
    got = json.loads(starting_offsets_json(resolved_positions(resolved)))
    assert got == {"t": {"0": 10, "1": 21}}
    assert json.loads(starting_offsets_json([("a", 0, EARLIEST)])) == {"a": {"0": -2}}
    with pytest.raises(ValueError):
        resolved_positions(resolved, max_rows=1)


from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

PARTS = st.dictionaries(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 2)),
                        st.lists(st.integers(0, 60), min_size=1, max_size=8, unique=True),
                        min_size=1, max_size=4)


@settings(max_examples=12, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(PARTS, st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 2), st.integers(-5, 80)),
                       max_size=5, unique_by=lambda x: (x[0], x[1])),
       st.sampled_from(["earliest", "latest", "none"]))
def test_replay_matches_model(spark, parts, stored, reset):
    from sigshape.sources.records import RECORD_SCHEMA
    data = [(t, p, o, None, None, f"{t}{p}:{o}", 0) for (t, p), offs in parts.items() for o in offs]
    recs = spark.createDataFrame(data, RECORD_SCHEMA)
    pos = positions_frame(spark, stored) if stored else spark.createDataFrame([], "topic string, partition int, cur bigint")
    stored_map = {(t, p): c for t, p, c in stored}
    expected, must_fail = set(), False
    for (t, p), offs in parts.items():
        lo, hi = min(offs), max(offs) + 1
        if (t, p) in stored_map:
            start = min(max(stored_map[(t, p)], lo), hi)
        elif reset == "earliest":
            start = lo
        elif reset == "latest":
            start = hi
        else:
            must_fail = True
            continue
        expected |= {(t, p, o) for o in offs if o >= start}
    out = replay_from_offsets(recs, pos, reset)
    if must_fail:
        with pytest.raises(Exception, match="reset policy none"):
            out.collect()
        return
    assert {(r.topic, r.partition, r.offset) for r in out.collect()} == expected


def test_footer_bounds_read_no_rows(spark, tmp_path):
    from sigshape.sources.offsets import footer_bounds
    from sigshape.sources.sinks import land_by_partition
    from sigshape.sources.testtables import event_records
    from conftest import SF_SMALL
    recs = event_records(spark, SF_SMALL)
    path = str(tmp_path / "landed")
    land_by_partition(recs, path)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    bounds = footer_bounds(spark, path)
    p = bounds._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MIN(offset), MAX(offset)]" in p and "PushedGroupBy: [topic, partition]" in p
    assert "ReadSchema: struct<topic:string,partition:int,min(offset):bigint,max(offset):bigint>" in p      # no data column
    assert sorted(map(tuple, bounds.collect())) == sorted(map(tuple, offset_bounds(recs).collect()))
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before


@settings(max_examples=10, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(PARTS, st.integers(1, 5))
def test_gaps_match_model(spark, parts, bits):
    """Also with cells so small that every level of them is crossed."""
    from sigshape.sources.offsets import offset_gaps
    from sigshape.sources.records import RECORD_SCHEMA
    data = [(t, p, o, None, None, "v", 0) for (t, p), offs in parts.items() for o in offs for _ in range(1 + o % 2)]
    got = sorted(map(tuple, offset_gaps(spark.createDataFrame(data, RECORD_SCHEMA), cell_bits=8 * bits).collect()))
    want = []
    for (t, p), offs in parts.items():
        o = sorted(offs)
        want += [(t, p, a + 1, b - 1, b - a - 1) for a, b in zip(o, o[1:]) if b > a + 1]
    assert got == sorted(want)


def test_gaps_across_cells_and_no_window_over_a_partition(spark):
    from sigshape.sources.offsets import CELL_BITS, offset_gaps
    offs = [0, 1, (1 << 16) - 1, 1 << 16, (1 << 16) + 5, 3 << 16, (1 << 40) + 7, (1 << 62)]
    out = offset_gaps(records(spark, [(o, "v") for o in offs]))
    assert sorted((r.first_missing, r.last_missing) for r in out.collect()) == [
        (a + 1, b - 1) for a, b in zip(offs, offs[1:]) if b > a + 1]
    p = offset_gaps(records(spark, [(0, "v")]))._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in p.splitlines() if "Window [" in x]
    assert len(windows) == 64 // CELL_BITS
    assert sum("cell#" in w for w in windows) == len(windows) - 1        # the last sees a row per 2 ** 48 offsets
