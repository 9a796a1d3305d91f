import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sigshape.conf import RegionSplitConf
from sigshape.functions.split import split_list_cell
from sigshape.operators.explode import (parallel_explode, region_fanout, region_in_rows,
                                        region_out_rows)
from conftest import records


def _lists(spark, rows):
    df = spark.createDataFrame(rows, "id int, d string, c string")
    return df.select("id", split_list_cell(F.col("d")).alias("d"), split_list_cell(F.col("c")).alias("c"))


def test_longer_companion_is_cut(spark):
    df = _lists(spark, [(1, "a|b", "x|y|z")])
    got = parallel_explode(df, "d", {"c": "c"}, keep=("id",)).collect()
    assert [(r.pos, r.elem, r.c) for r in got] == [(0, "a", "x"), (1, "b", "y")]


def test_shorter_companion_fails(spark):
    df = _lists(spark, [(1, "a|b", "x")])
    with pytest.raises(Exception, match="shorter than driver"):
        parallel_explode(df, "d", {"c": "c"}, keep=("id",)).collect()


def test_shorter_companion_quarantined(spark):
    df = _lists(spark, [(1, "a|b", "x"), (2, "a", "x")])
    good, bad = parallel_explode(df, "d", {"c": "c"}, keep=("id",), on_short="quarantine")
    assert [r.id for r in good.collect()] == [2]
    assert [r.id for r in bad.collect()] == [1]


def test_driver_of_separators_only_gives_no_rows(spark):
    df = _lists(spark, [(1, "|", "")])
    assert parallel_explode(df, "d", {"c": "c"}).count() == 0


def test_all_blank_cells_give_one_blank_row(spark):
    df = _lists(spark, [(1, "", "")])
    got = parallel_explode(df, "d", {"c": "c"}).collect()
    assert [(r.pos, r.elem, r.c) for r in got] == [(0, "", "")]


def wide(imsi="i1", regions="r1|r2", in_times="t1|t2", flags="0|1",
         out_regions="o1", out_in="a1", out_out="b1", stay="s1", width=34):
    f = [""] * width
    f[0], f[1] = imsi, "20240101"
    for i in range(10, 18):
        f[i] = f"c{i}"
    f[24], f[25] = "oc", "ocn"
    cells = {9: regions, 28: in_times, 29: flags, 30: out_regions, 31: out_in, 32: out_out, 33: stay}
    for i, v in cells.items():
        if i < width:
            f[i] = v
    return ",".join(f)


def test_region_rows_layout(spark):
    df = records(spark, [(1, wide())])
    rows = region_in_rows(df).collect()
    assert [r.region for r in rows] == ["r1", "r2"]
    assert [r.in_time for r in rows] == ["t1", "t2"] and [r.flag for r in rows] == ["0", "1"]
    r = rows[0]
    assert (r.imsi, r.timestamp, r.city, r.arpu_level) == ("i1", "20240101", "c10", "c17")
    out = region_out_rows(df).collect()
    assert [(o.region, o.in_time, o.out_time, o.stay, o.out_city, o.out_county) for o in out] == \
        [("o1", "a1", "b1", "s1", "oc", "ocn")]


def test_blank_out_cells_give_one_blank_left_row(spark):
    df = records(spark, [(1, wide(out_regions="", out_in="", out_out="", stay=""))])
    out = region_out_rows(df).collect()
    assert len(out) == 1 and out[0].region == "" and out[0].stay == ""


def test_fanout_order_and_topics(spark):
    conf = RegionSplitConf(topic_in="IN", topic_out="OUT")
    got = region_fanout(records(spark, [(1, wide())]), conf).collect()
    assert [m.topic for m in got] == ["IN", "IN", "OUT"]
    assert all(m.key == "i1" for m in got)
    assert got[0].value == "i1,r1,20240101,c10,c11,c12,c13,c14,c15,c16,c17,t1,0"
    assert got[2].value == "i1,o1,20240101,a1,b1,s1,oc,ocn"


def test_element_with_semicolon_stays_one_message(spark):
    got = region_fanout(records(spark, [(1, wide(regions="r;1", in_times="t", flags="0"))])).collect()
    assert [m.value.split(",")[1] for m in got if m.topic == "region_in"] == ["r;1"]


def test_null_and_empty_lines_are_dropped(spark):
    df = records(spark, [(1, None), (2, ""), (3, wide())])
    assert region_in_rows(df).count() == 2


def test_width_guard_fails_even_under_count(spark):
    df = records(spark, [(1, wide(width=33))])
    with pytest.raises(Exception, match="fewer than 34 fields"):
        region_in_rows(df).count()
    with pytest.raises(Exception, match="fewer than 34 fields"):
        region_fanout(df).count()


def test_short_companion_fails_under_count(spark):
    df = records(spark, [(1, wide(regions="a|b", in_times="t"))])
    with pytest.raises(Exception, match="shorter than driver"):
        region_in_rows(df).count()


def test_quarantine_routes_bad_lines(spark):
    df = records(spark, [(1, wide(width=33)), (2, wide(regions="a|b", in_times="t")), (3, wide())])
    good, bad = region_fanout(df, RegionSplitConf(on_malformed="quarantine"), keep=("offset",))
    assert sorted({r.offset for r in good.collect()}) == [3]
    assert sorted((r.offset, r.reason) for r in bad.collect()) == [
        (1, "too few fields"), (2, "short companion list")]


def test_fanout_count_equals_list_sizes(spark):
    from sigshape.sources.testtables import wide_signal_records
    from conftest import SF_SMALL
    recs = wide_signal_records(spark, SF_SMALL)
    n_in = region_in_rows(recs).count()
    n_out = region_out_rows(recs).count()
    assert region_fanout(recs).count() == n_in + n_out
    assert region_fanout(recs.repartition(3)).count() == n_in + n_out


def test_one_hot_order_falls_into_many_lines(spark, tmp_path):
    """An order with very many items is cut by their part blocks, the rule of
    every order; the rows are those of its items."""
    from pyspark.sql import functions as F
    from sigshape.sources.testtables import PART_BLOCK, order_lists, wide_signal_records
    from conftest import SF_SMALL
    for t in ("orders", "lineitem"):
        df = spark.read.parquet(f"{SF_SMALL}/{t}.parquet")
        if t == "lineitem":
            hot = df.limit(1).crossJoin(spark.range(20_000).withColumnRenamed("id", "k"))
            hot = hot.withColumn("l_partkey", F.col("k") * 3).drop("k")
            df = df.unionByName(hot)
        df.write.parquet(str(tmp_path / f"{t}.parquet"))
    sizes = [r.n for r in order_lists(spark, str(tmp_path)).select(F.size("elems").alias("n")).collect()]
    assert sum(sizes) == spark.read.parquet(str(tmp_path / "lineitem.parquet")).count()
    assert max(sizes) < PART_BLOCK / 2
    recs = wide_signal_records(spark, str(tmp_path))
    blank = recs.where(F.element_at(F.split("value", ","), 10) == "").count()
    assert region_in_rows(recs).count() == sum(sizes) + blank


@pytest.mark.parametrize("name", ["parallel_explode", "project_signal", "split_list_cell"])
def test_an_order_of_many_part_blocks_has_one_list(spark, tmp_path, name):
    """Part keys of several blocks: the list, its half and its places are the whole order's."""
    import duckdb
    from pyspark.sql import functions as F
    from sigshape.plans.oracle import ORACLE
    from sigshape.plans.registry import QUERIES
    from sigshape.sources.testtables import PART_BLOCK
    from conftest import SF_SMALL
    con = duckdb.connect()
    for t in ("orders", "lineitem"):
        df = spark.read.parquet(f"{SF_SMALL}/{t}.parquet")
        if t == "lineitem":
            df = df.withColumn("l_partkey", F.col("l_partkey") + F.col("l_linenumber") * PART_BLOCK)
        df.write.parquet(str(tmp_path / f"{t}.parquet"))
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    out = QUERIES[name](spark, str(tmp_path))
    want = con.sql(ORACLE[name]).select(*[f'"{c}"' for c in out.columns]).fetchall()
    assert "//" not in ORACLE[name].replace("(r.n + 1) // 2", "")             # no blocks
    assert sorted(map(tuple, out.collect())) == sorted(want)
    if name == "project_signal":
        assert len(want) == spark.read.parquet(str(tmp_path / "orders.parquet")).count()


def test_tagged_fanout_is_good_plus_quarantined(spark):
    from sigshape.operators.explode import region_fanout_tagged
    df = records(spark, [(1, wide()), (2, wide(width=33)), (3, wide(out_regions="a|b", out_in="x")), (4, "x")])
    good, bad = region_fanout(df, RegionSplitConf(on_malformed="quarantine"), keep=("offset",))
    out = region_fanout_tagged(df, RegionSplitConf(), keep=("offset",))
    key = lambda rows: sorted(map(tuple, rows.collect()), key=repr)
    assert key(out.where("reason is null").select("offset", "topic", "key", "value")) == key(good)
    assert key(out.where("reason is not null").select("offset", "n_fields", "reason")) == key(bad)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(value") == 1


def test_project_signal_guard_survives_count(spark):
    from sigshape.operators.parse import project_signal
    df = records(spark, [(1, wide()), (2, wide(width=33))])
    with pytest.raises(Exception, match="fewer than 34 fields"):
        project_signal(df).count()
    good = project_signal(records(spark, [(1, wide())]))
    assert good.count() == 1 and good.first().region_code == "r1|r2"
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") == 1            # the line is split once


def test_row_functions_quarantine_too(spark):
    df = records(spark, [(1, wide(width=33)), (2, wide(out_regions="a|b", out_in="x")), (3, wide())])
    good_in, bad_in = region_in_rows(df, keep=("offset",), on_malformed="quarantine")
    assert sorted({r.offset for r in good_in.collect()}) == [2, 3]      # line 2's current lists are fine
    assert [(r.offset, r.reason) for r in bad_in.collect()] == [(1, "too few fields")]
    good_out, bad_out = region_out_rows(df, keep=("offset",), on_malformed="quarantine")
    assert sorted({r.offset for r in good_out.collect()}) == [3]
    assert sorted((r.offset, r.reason) for r in bad_out.collect()) == [
        (1, "too few fields"), (2, "short companion list")]
