"""Sharding: the capacity is the optimum, groups stay whole, slots are gapless."""
import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from llm_helpers import EDGE, docs_frame, small_documents

from sigshape.llm.sharding import greedy_cuts, minimax_cuts, shard_rows, smallest


def optimum(sizes, shards):
    """Smallest capacity by trying every one."""
    lo = max(max(sizes), -(-sum(sizes) // shards))
    while True:
        n, room = 1, lo
        for s in sizes:
            if s > room:
                n, room = n + 1, lo
            room -= s
        if n <= shards:
            return lo
        lo += 1


@pytest.mark.parametrize("seed,shards", [(0, 2), (1, 4), (2, 7), (3, 16)])
def test_capacity_is_the_smallest(spark, seed, shards):
    rng = random.Random(seed)
    keys = sorted(hashlib.md5(str(rng.random()).encode()).hexdigest() for _ in range(300))
    sizes = [rng.randint(1, 400) if seed < 3 else (9000 if i == 7 else rng.randint(1, 90)) for i in range(300)]
    groups = spark.createDataFrame(list(zip(keys, sizes, [1] * 300)), "key string, size bigint, n bigint")
    capacity, cuts = minimax_cuts(groups, shards)
    assert capacity == optimum(sizes, shards)
    load = defaultdict(int)
    for k, s in zip(keys, sizes):
        load[sum(k >= c for c in cuts)] += s
    assert len(load) <= shards and max(load.values()) <= capacity


def test_coarse_segments_are_refined(spark, monkeypatch):
    """Few segments come back: the search has to split them again and again."""
    import sigshape.llm.sharding as m
    monkeypatch.setattr(m, "FIRST_DIGITS", 1)
    monkeypatch.setattr(m, "SEGMENTS", 64)
    rng = random.Random(9)
    keys = sorted(hashlib.md5(str(i).encode()).hexdigest() for i in range(2000))
    sizes = [rng.randint(1, 500) for _ in keys]
    groups = spark.createDataFrame(list(zip(keys, sizes, [1] * len(keys))), "key string, size bigint, n bigint")
    assert minimax_cuts(groups, 5)[0] == optimum(sizes, 5)


def test_greedy_check():
    segments = [("a", 5, 5, 1, 0), ("b", 7, 7, 1, 0), ("c", 3, 3, 1, 0)]
    assert greedy_cuts(segments, 2, 9, inside=False) is None
    assert greedy_cuts(segments, 2, 10, inside=False) == [5]
    assert smallest(segments, 2, 7, 15, inside=False) == 10


def check(rows, out):
    assert len(out) == len(rows)
    shards, of_text = defaultdict(list), defaultdict(set)
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append(t or "")
    for r in out:
        shards[r.shard].append(r)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 16
        raw = {(len(t.encode()) + 1, zlib.crc32(t.encode())) for t in texts[r.doc_id]}
        assert (r.size, r.text_crc32) in raw
        of_text[(r.size, r.text_crc32)].add(r.shard)
    assert all(len(s) == 1 for s in of_text.values())
    assert all(sorted(r.slot for r in s) == list(range(len(s))) for s in shards.values())


def test_edges(spark):
    check(EDGE, shard_rows(docs_frame(spark, EDGE)).collect())
    assert shard_rows(docs_frame(spark, [])).collect() == []


def test_small_table_is_even(spark):
    docs = small_documents(spark)
    out = shard_rows(docs).collect()
    check([(r.doc_id, r.text) for r in docs.collect()], out)
    load = defaultdict(int)
    for r in out:
        load[r.shard] += r.size
    groups = {}
    for r in docs.collect():
        k = hashlib.md5((r.text or "").encode()).hexdigest()
        groups[k] = groups.get(k, 0) + len((r.text or "").encode()) + 1
    assert max(load.values()) == optimum([groups[k] for k in sorted(groups)], 16)


def test_slots_of_a_hot_shard_span_many_cells(spark, monkeypatch):
    import sigshape.llm.sharding as m
    monkeypatch.setattr(m, "CELL_ROWS", 5)
    rows = [(i, "same text") for i in range(400)] + [(1000 + i, f"other {i}") for i in range(100)]
    check(rows, shard_rows(docs_frame(spark, rows)).collect())


def test_shards_beside_a_hot_group_are_even(spark):
    """Half of the bytes are one text: 15 shards share the rest evenly."""
    rng = random.Random(4)
    rows = [(i, "hot text " * 40) for i in range(200)] + [(1000 + i, f"{i} " * rng.randint(5, 60)) for i in range(600)]
    out = shard_rows(docs_frame(spark, rows)).collect()
    check(rows, out)
    load = defaultdict(int)
    for r in out:
        load[r.shard] += r.size
    hot = 200 * (len("hot text " * 40) + 1)
    rest = sorted(v for v in load.values() if v != hot)
    assert len(load) == 16 and max(load.values()) == hot and len(rest) == 15
    assert rest[-1] < 1.2 * sum(rest) / 15 and rest[0] > 0.5 * sum(rest) / 15


@pytest.mark.parametrize("seed", range(4))
def test_several_oversized_groups(spark, seed):
    """The largest shard is the optimum; the largest of the rest is the optimum of the parts between."""
    rng = random.Random(seed)
    keys = sorted(hashlib.md5(str(rng.random()).encode()).hexdigest() for _ in range(80))
    big = set(rng.sample(range(80), 1 + seed))
    sizes = [9000 + 500 * (i % 3) if i in big else rng.randint(1, 60) for i in range(80)]
    groups = spark.createDataFrame(list(zip(keys, sizes, [1] * 80)), "key string, size bigint, n bigint")
    capacity, cuts = minimax_cuts(groups, 8)
    assert capacity == optimum(sizes, 8) and len(cuts) <= 7
    load = defaultdict(int)
    for k, x in zip(keys, sizes):
        load[sum(k >= c for c in cuts)] += x
    assert max(load.values()) == capacity and len(load) == len(cuts) + 1
    parts, part = [[]], 0
    for i, x in enumerate(sizes):
        if i in big:
            parts.append([])
        else:
            parts[-1].append(x)
    left = 8 - len(big)

    def shards_of(limit):
        n = 0
        for p in parts:
            room = 0
            for x in p:
                if x > room:
                    n, room = n + 1, limit
                room -= x
        return n

    if sum(map(bool, parts)) <= left:                     # else there are more gaps than shards
        best = next(c for c in range(max(map(max, filter(None, parts))), 10**6) if shards_of(c) <= left)
        assert max(v for v in load.values() if v < 9000) <= best


def test_more_gaps_than_shards_falls_back(spark):
    keys = [f"{i:032x}" for i in range(9)]
    sizes = [1, 100, 1, 100, 1, 100, 1, 100, 1]
    groups = spark.createDataFrame(list(zip(keys, sizes, [1] * 9)), "key string, size bigint, n bigint")
    capacity, cuts = minimax_cuts(groups, 5)
    assert capacity == optimum(sizes, 5) and len(cuts) <= 4


def test_repeated_rows_fall_into_many_cells(spark, monkeypatch):
    """Rows of one id and text are told apart, so no cell holds all of them."""
    import sigshape.llm.sharding as m
    monkeypatch.setattr(m, "CELL_ROWS", 5)
    rows = [(7, "again")] * 300 + [(i, f"own {i}") for i in range(50)]
    seen = []
    real = m.gapless_rank

    def spy(df, *a, salt, **kw):
        from pyspark.sql import functions as F
        cells = df.groupBy("shard", F.pmod(F.xxhash64(*salt), a[1].cast("bigint")).alias("c")).count()
        seen.extend(r["count"] for r in cells.collect())
        return real(df, *a, salt=salt, **kw)

    monkeypatch.setattr(m, "gapless_rank", spy)
    check(rows, shard_rows(docs_frame(spark, rows)).collect())
    assert max(seen) < 100
