"""Plan shapes that matter at scale, checked on landed record tables."""
import re

import pytest

from sigshape.conf import DedupConf
from sigshape.operators.dedup import dedup_latest
from sigshape.operators.explode import region_fanout, region_in_rows
from sigshape.plans.registry import STORED_POSITIONS
from sigshape.sources.offsets import positions_frame, replay_from_offsets
from sigshape.sources.records import read_records, subscribe_topics
from sigshape.operators.parse import clean_records
from sigshape.sources.testtables import event_records, wide_signal_records
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("landed")
    wide_signal_records(spark, SF_SMALL).write.parquet(str(root / "wide"))
    event_records(spark, SF_SMALL).write.parquet(str(root / "events"))
    return (lambda: read_records(spark, "parquet", str(root / "wide")),
            lambda: read_records(spark, "parquet", str(root / "events")))


def plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()          # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_fanout_is_one_codegen_stage_without_shuffle(landed):
    wide, _ = landed
    p = plan(region_fanout(wide()))
    assert "Exchange" not in p
    assert p.count("split(value") == 1                      # the line is split once
    assert re.search(r"\*\(\d+\) Generate posexplode", p)   # generator inside codegen
    assert "ReadSchema: struct<value:string>" in p          # only the value column is read
    assert "IsNotNull(value)" in p


def test_row_split_reads_only_needed_columns(landed):
    wide, _ = landed
    p = plan(region_in_rows(wide(), keep=("offset",)))
    assert "ReadSchema: struct<offset:bigint,value:string>" in p
    assert "Exchange" not in p


def test_dedup_limits_rows_before_the_shuffle(landed):
    _, events = landed
    p = plan(dedup_latest(events(), DedupConf(), "row_number"))
    assert p.count("WindowGroupLimit") == 2                 # partial below, final above the exchange
    assert p.count("Exchange hashpartitioning") == 1
    assert p.count("split(value") == 1
    p = plan(dedup_latest(events(), DedupConf(), "max_by"))
    assert "partial_max_by" in p and p.count("Exchange hashpartitioning") == 1


def test_replay_broadcasts_the_small_side(spark, landed):
    _, events = landed
    df = replay_from_offsets(events(), positions_frame(spark, STORED_POSITIONS), "none")
    p = plan(df)
    assert "BroadcastHashJoin" in p
    # the record side reaches the join without being shuffled
    join_line = [ln for ln in p.splitlines() if "BroadcastHashJoin" in ln][0]
    assert "SortMergeJoin" not in join_line


def test_filters_reach_the_scan(landed):
    _, events = landed
    p = plan(subscribe_topics(events(), "click,view"))
    assert re.search(r"PushedFilters: \[[^\]]*In\(topic", p)
    p = plan(clean_records(events()))
    assert "IsNotNull(value)" in p and "Not(EqualTo(value,))" in p


@pytest.mark.parametrize("reset", ["none", "earliest", "latest"])
def test_replay_is_one_scan(spark, landed, reset):
    _, events = landed
    p = plan(replay_from_offsets(events(), positions_frame(spark, STORED_POSITIONS), reset))
    assert p.count("FileScan parquet") == 1 and "HashAggregate" not in p


def test_positions_beyond_the_broadcast_threshold_are_shuffled(spark, landed):
    _, events = landed
    pos = positions_frame(spark, STORED_POSITIONS)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        a = replay_from_offsets(events(), pos, "none")
        assert "SortMergeJoin" in plan(a)
        rows = sorted(map(tuple, a.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows == sorted(map(tuple, replay_from_offsets(events(), pos, "none").collect()))


def test_wide_lines_read_lineitem_once_and_shuffle_raw_columns(spark):
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    df = wide_signal_records(spark, SF_SMALL)
    # building runs no job but the two tables' schema reads
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) <= len(jobs) + 2
    p = plan(df)
    assert p.count("lineitem.parquet") == 1
    scan = [ln for ln in p.splitlines() if "lineitem.parquet" in ln][0]
    assert scan.count("l_shipdate") >= 1 and "l_extendedprice" not in scan


def test_a_wide_line_is_built_once_without_interpreted_lambdas(spark):
    p = region_fanout(wide_signal_records(spark, SF_SMALL))._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("concat_ws(,, cast(o_custkey") == 1 and "lambda" not in p
    from pyspark.sql import functions as F
    from sigshape.functions.split import split_csv
    from sigshape.conf import WIDE_LAYOUT
    f = split_csv(F.col("value"), ",")
    sizes = wide_signal_records(spark, SF_SMALL).select(F.size(F.split(f[WIDE_LAYOUT["region_code"]], "\\|")).alias("n"))
    assert sizes.agg(F.avg("n")).first()[0] >= 4            # lists of several elements


def test_quarantine_paths_split_once(landed):
    from sigshape.operators.dedup import keyed_lines
    _, events = landed
    p = plan(keyed_lines(events(), DedupConf(on_malformed="quarantine")))
    assert p.count("split(value") == 1


def test_topic_partitioned_landing_is_pruned(spark, tmp_path):
    path = str(tmp_path / "by_topic")
    event_records(spark, SF_SMALL).write.partitionBy("topic").parquet(path)
    recs = lambda: read_records(spark, "parquet", path)
    p = plan(subscribe_topics(recs(), "click,view"))
    assert re.search(r"PartitionFilters: \[[^\]]*topic#\d+ IN \(click,view\)", p)


def test_project_signal_reads_only_needed_columns(landed):
    from sigshape.operators.parse import project_signal
    wide, _ = landed
    p = plan(project_signal(wide(), keep=("offset",)))
    assert "ReadSchema: struct<offset:bigint,value:string>" in p


def test_other_operators_read_only_needed_columns(landed):
    from sigshape.operators.tap import tap_records
    from sigshape.sources.offsets import offset_bounds
    _, events = landed
    assert "ReadSchema: struct<topic:string,partition:int,offset:bigint>" in plan(offset_bounds(events()))
    assert "ReadSchema: struct<partition:int,offset:bigint,key:string,value:string>" in plan(tap_records(events()))
    p = plan(dedup_latest(events(), DedupConf()))
    assert "ReadSchema: struct<topic:string,partition:int,offset:bigint,value:string,batch_id:bigint>" in p


def _shuffle_records(df):
    """shuffleRecordsWritten of every exchange in the executed (adaptive) plan."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found = []

    def walk(node):
        name = node.nodeName()
        if name.startswith("Exchange"):
            metric = node.metrics().get("shuffleRecordsWritten")
            if metric.isDefined():
                found.append(metric.get().value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))
        if "QueryStage" in name:
            walk(node.plan())
    walk(plan.finalPhysicalPlan())
    return found


@pytest.mark.parametrize("method", ["row_number", "max_by"])
def test_hot_key_ships_one_row_per_map_task(spark, method):
    """A key holding a third of all rows adds one shuffled row per map task."""
    from pyspark.sql import functions as F
    n, tasks = 30_000, 12
    hot = F.col("id") % 3 == 0
    df = spark.range(n).repartition(tasks).select(
        F.lit("t").alias("topic"), (F.col("id") % 4).cast("int").alias("partition"),
        F.col("id").alias("offset"), F.lit(None).cast("timestamp_ntz").alias("timestamp"),
        F.lit(None).cast("string").alias("key"),
        F.concat_ws("|", F.when(hot, F.lit("HOT")).otherwise(F.col("id").cast("string")), F.lit("x"),
                    F.lit("m"), (F.col("id") % 97).cast("string"), F.lit("L"), F.lit("C")).alias("value"),
        F.lit(0).cast("bigint").alias("batch_id"))
    out = dedup_latest(df, DedupConf(), method)
    shuffled = _shuffle_records(out)
    cold_keys = n - n // 3
    assert min(shuffled) == cold_keys + tasks       # the input repartition shuffles all 30,000
    assert out.count() == cold_keys + 1


def test_replay_shuffles_nothing(spark, landed):
    _, events = landed
    pos = positions_frame(spark, STORED_POSITIONS)
    out = replay_from_offsets(events(), pos, "none")
    assert _shuffle_records(out) == []                 # broadcast join only
