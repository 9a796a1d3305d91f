"""SimHash: fingerprints, covering masks and components against brute force."""
import itertools
import random
import re
from collections import defaultdict

import pytest
import xxhash
from llm_helpers import EDGE, ascii_lower, docs_frame, small_documents
from pyspark.sql import functions as F

from sigshape.llm.common import ship
from sigshape.llm.components import components
from sigshape.llm.simhash import covering_masks, drop_near_copies, fingerprint, links, near_duplicates


def brute_fingerprint(text, k=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text or ""))
    shingles = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(values, radius=4):
    """value -> set of values linked to it, through any chain."""
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v
    for a, b in itertools.combinations(sorted(parent), 2):
        if (a ^ b).bit_count() <= radius:
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    return {v: root(v) for v in values}


def check(rows, out):
    fps = [(i, brute_fingerprint(t)) for i, t in rows]
    assert sorted(((r.doc_id, int(r.fingerprint, 16)) for r in out), key=repr) == sorted(fps, key=repr)
    root = brute_components({f for _, f in fps})
    least = {}
    for i, f in fps:
        if i is not None:
            least[root[f]] = min(least.get(root[f], i), i)
    assert all(r.component_id == least.get(root[int(r.fingerprint, 16)]) for r in out)
    assert all(len(r.fingerprint) == 16 for r in out)


def test_every_pair_within_the_radius_shares_a_table():
    rng = random.Random(1)
    for radius in (1, 2, 4):
        masks = covering_masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for _ in range(3000):
            d = sum(1 << b for b in rng.sample(range(64), rng.randint(1, radius)))
            assert any(d & m == 0 for m in masks)
        assert all(20 < m.bit_count() < 50 for m in masks)


def test_spark_agrees_on_the_shingle_hash(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b c é"))).first()[0] % 2**64 == xxhash.xxh64_intdigest("a b c é".encode(), 42)


def test_fingerprint_of_texts():
    for t in ["", " ", "one", "one two", "A B C D E F", "É é À", "x " * 500, "a\x1cb c\x85d e f", "one\x0btwo\x0cthree four"]:
        assert fingerprint(t) == brute_fingerprint(t)


def test_edges(spark):
    check(EDGE, near_duplicates(docs_frame(spark, EDGE)).collect())
    assert near_duplicates(docs_frame(spark, [])).collect() == []


def test_small_table(spark):
    docs = small_documents(spark)
    check([(r.doc_id, r.text) for r in docs.collect()], near_duplicates(docs).collect())


@pytest.mark.parametrize("block", [4, 2048])
def test_links_connect_what_brute_force_connects(spark, block):
    """Tight clusters, in one bucket or cut into many blocks; links stay few."""
    ship(spark)
    rng = random.Random(block)
    values = set()
    for _ in range(6):
        center = rng.getrandbits(64)
        for _ in range(40):
            values.add(center ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))))
    signed = {v - (1 << 64) if v >> 63 else v: v for v in values}
    found = links(spark.createDataFrame([(v,) for v in signed], "fp bigint"), block=block)
    pairs = [(signed[r.u], signed[r.v]) for r in found.collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in pairs)
    want = brute_components(values)
    got = brute_components(values, radius=-1)
    parent = dict(got)

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v
    for a, b in pairs:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    groups = lambda m: {frozenset(v for v in values if m(v) == r) for r in {m(v) for v in values}}
    assert groups(root) == groups(lambda v: want[v])


def test_no_side_of_the_bucket_join_is_broadcast(spark, tmp_path):
    """Spark counts a fingerprint's 31 rows as one: both sides look small."""
    ship(spark)
    spark.range(1000).select(F.xxhash64("id").alias("fp")).write.parquet(f"{tmp_path}/fps")
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "10m")
    try:
        found = links(spark.read.parquet(f"{tmp_path}/fps"))
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(limit, before)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(5)
    edges = {"chain": [(i, i + 1) for i in range(60)], "star": [(7, i) for i in range(100, 160)],
             "random": [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(60)], "none": []}[shape]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    near = defaultdict(set)
    for a, b in edges:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    want = {}
    for s in sorted(near):
        todo = [] if s in want else [s]
        while todo:
            x = todo.pop()
            if x not in want:
                want[x] = s
                todo += near[x]
    assert got == want


def test_dropping_keeps_one_of_each_component(spark):
    docs = small_documents(spark)
    out = drop_near_copies(docs)
    assert out.schema == docs.schema
    found = near_duplicates(docs).collect()
    assert sorted(r.doc_id for r in out.collect()) == sorted({r.component_id for r in found})
