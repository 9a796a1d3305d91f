"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Records are first derived from the test tables and landed as parquet (as a
stream's records would be landed); then each operator runs over the landed
table and is forced with the ``noop`` sink. All cases are warmed up twice,
then timed in $BENCH_RUNS interleaved rounds; each value is the median.
Prints ONE JSON line.

``BENCH_SCALE=k`` lands k copies of the records (offsets shifted apart) for
steady-state numbers; the default 1 measures the given tables as they are.
Spark's event log goes to the scratch folder; one extra tagged run per case
gives input records and shuffle volume per query (``io`` in the output).

The headline is the sum of the three operators over landed records and of the
end-to-end fan-out query (encoding from the base tables + operator).

two-pass fan-out, which caches afresh in every run; ``row_number`` vs
``max_by`` dedup) and the end-to-end registry queries of the other headline keys.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sigshape.conf import DedupConf, RegionSplitConf  # noqa: E402
from sigshape.operators.dedup import dedup_latest  # noqa: E402
from sigshape.operators.explode import region_fanout, region_fanout_two_pass  # noqa: E402
from sigshape.operators.parse import project_signal  # noqa: E402
from sigshape.operators.tap import tap_records  # noqa: E402
from sigshape.plans.registry import QUERIES, STORED_POSITIONS  # noqa: E402
from sigshape.session import local_session  # noqa: E402
from sigshape.sources.offsets import positions_frame, replay_from_offsets  # noqa: E402
from sigshape.sources.records import read_records  # noqa: E402
from sigshape.sources.testtables import event_records, wide_signal_records  # noqa: E402
from sigshape.streaming.runners import (BatchTimeLogger, region_split_writer, run_dedup,  # noqa: E402
                                        run_landed)

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
_cpus = os.environ.get("BENCH_CPUS", "8").strip()
CPUS = str(os.cpu_count() or 8) if _cpus in ("", "*") else _cpus
RUNS = int(os.environ.get("BENCH_RUNS", "5"))
SCALE = int(os.environ.get("BENCH_SCALE", "1"))   # >1: land that many copies (shifted offsets)
HEADLINE = ("region_fanout", "dedup_latest", "replay_from_offsets")
END_TO_END = "e2e_region_fanout"


def _sf(path: str) -> float | str:
    base = os.path.basename(path.rstrip("/"))
    try:
        return float(base.replace("sf", ""))
    except ValueError:
        return base


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(make, runs: int = RUNS) -> float:
    run(make())                                   # warm-up
    times = []
    for _ in range(runs):
        t = time.perf_counter()
        run(make())
        times.append(time.perf_counter() - t)
    return round(statistics.median(times), 4)


def io_metrics(log_dir: str) -> dict[str, dict[str, int]]:
    """Input records and shuffle bytes per job description, from the event log."""
    stage_owner, totals = {}, {}
    paths = sorted(p for p in glob.glob(f"{log_dir}/**/*", recursive=True) if os.path.isfile(p))
    for path in paths:
        if os.path.basename(path).startswith("appstatus"):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description", "")
                    if desc.startswith("metrics:"):
                        for sid in ev.get("Stage IDs", []):
                            stage_owner[sid] = desc[len("metrics:"):]
                elif kind == "SparkListenerTaskEnd" and ev.get("Stage ID") in stage_owner:
                    m = ev.get("Task Metrics") or {}
                    t = totals.setdefault(stage_owner[ev["Stage ID"]],
                                          {"input_records": 0, "shuffle_write_bytes": 0,
                                           "shuffle_write_records": 0})
                    t["input_records"] += (m.get("Input Metrics") or {}).get("Records Read", 0)
                    t["shuffle_write_records"] += (m.get("Shuffle Write Metrics") or {}).get(
                        "Shuffle Records Written", 0)
                    t["shuffle_write_bytes"] += (m.get("Shuffle Write Metrics") or {}).get(
                        "Shuffle Bytes Written", 0)
    return totals


def scaled(df, k: int):
    """``k`` copies of a record table with offsets shifted apart (steady-state runs)."""
    out = df
    for i in range(1, k):
        out = out.unionByName(df.withColumn("offset", df["offset"] + i * 1_000_000_000))
    return out


def slowest(batches: list[tuple], rows: int) -> float:
    """Seconds of the slowest micro-batch, once all ``rows`` were reported;
    empties the list."""
    deadline = time.time() + 30                   # listener events arrive later
    while time.time() < deadline and sum(b[2] for b in batches) < rows:
        time.sleep(0.1)
    worst = max((b[3] for b in batches), default=0.0)
    batches.clear()
    return worst


def main() -> None:
    scratch = tempfile.mkdtemp(prefix="sigshape-bench-")
    log_dir = f"{scratch}/eventlog"
    os.makedirs(log_dir)
    spark = local_session(cores=CPUS, shuffle_partitions=int(CPUS) * 2, app="sigshape-bench",
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log_dir}",
                                 "spark.eventLog.compress": "false"})
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{scratch}/ckpt")
    split_conf, dedup_conf = RegionSplitConf(), DedupConf()

    q: dict[str, float] = {}
    # Land records as several files, as a topic with several partitions would.
    # The first landing warms the JVM up (class loading, JIT); the second is timed.
    n_files = int(CPUS) * 2 * SCALE
    for attempt in ("warm", "timed"):
        t = time.perf_counter()
        scaled(wide_signal_records(spark, SF_DIR), SCALE).repartition(n_files).write.parquet(
            f"{scratch}/wide-{attempt}")
        q["land_wide_lines"] = round(time.perf_counter() - t, 4)
        t = time.perf_counter()
        scaled(event_records(spark, SF_DIR), SCALE).repartition(n_files).write.parquet(
            f"{scratch}/events-{attempt}")
        q["land_event_lines"] = round(time.perf_counter() - t, 4)

    wide = lambda: read_records(spark, "parquet", f"{scratch}/wide-timed")      # noqa: E731
    events = lambda: read_records(spark, "parquet", f"{scratch}/events-timed")
    n_wide, n_events = wide().count(), events().count()
    n_msgs = region_fanout(wide(), split_conf).count()
    positions = positions_frame(spark, STORED_POSITIONS)

    def two_pass():
        msgs, cached = region_fanout_two_pass(wide(), split_conf)
        done.append(cached)
        return msgs
    done = []                                     # what a run has cached, dropped after it

    def run_fresh(make):
        run(make())
        while done:
            done.pop().unpersist(blocking=True)

    cases = {
        "region_fanout": lambda: region_fanout(wide(), split_conf),
        "dedup_latest": lambda: dedup_latest(events(), dedup_conf, "row_number"),
        "replay_from_offsets": lambda: replay_from_offsets(
            events(), positions, "none"),
        "region_fanout_two_pass": two_pass,
        "dedup_latest_max_by": lambda: dedup_latest(events(), dedup_conf, "max_by"),
        "project_signal": lambda: project_signal(wide()),
        "tap_records": lambda: tap_records(events()),
    }
    for _ in range(2):                            # warm-up: JIT and file caches for every case
        for make in cases.values():
            run_fresh(make)
    samples = {k: [] for k in cases}
    for _ in range(RUNS):                         # interleaved rounds, median per case
        for k, make in cases.items():
            t = time.perf_counter()
            run_fresh(make)
            samples[k].append(time.perf_counter() - t)
    for k, v in samples.items():
        q[k] = round(statistics.median(v), 4)
    for k, make in cases.items():                 # one more run per case, tagged for the event log
        spark.sparkContext.setJobDescription(f"metrics:{k}")
        run_fresh(make)
    spark.sparkContext.setJobDescription(None)

    for name in HEADLINE:                         # end to end: encode from tables + operator
        q[f"e2e_{name}"] = timed(lambda name=name: QUERIES[name](spark, SF_DIR), runs=1)

    # Streams over the landed tables: the slowest micro-batch (here the whole
    # table is one) is what has to fit in the jobs' 60 s trigger interval.
    batches: list[tuple] = []
    spark.streams.addListener(BatchTimeLogger(batches.append))
    run_dedup(spark, events(), dedup_conf, name="bench-stream-dedup")
    q["stream_dedup_max_batch"] = slowest(batches, n_events)
    run_landed(spark, wide(), "bench-stream-fanout",
               lambda stream, out: region_split_writer(stream, out, split_conf))
    q["stream_fanout_max_batch"] = slowest(batches, n_wide)

    value = round(sum(q[h] for h in HEADLINE) + q[END_TO_END], 4)
    version = spark.version
    spark.stop()                                  # flushes the event log
    io = io_metrics(log_dir)
    print(json.dumps({
        "metric": "headline_seconds_sum",
        "value": value,
        "unit": "sec",
        "queries": q,
        "sf": _sf(SF_DIR),
        "scale": SCALE,
        "cpus": int(CPUS),
        "rows": {"wide_lines": n_wide, "messages": n_msgs, "event_lines": n_events},
        "rows_per_sec": {
            "region_fanout_lines": round(n_wide / q["region_fanout"]),
            "region_fanout_messages": round(n_msgs / q["region_fanout"]),
            "dedup_latest": round(n_events / q["dedup_latest"]),
            "replay_from_offsets": round(n_events / q["replay_from_offsets"]),
        },
        "io": io,
        "spark": version,
    }))


if __name__ == "__main__":
    main()
