"""Exact dedup against brute force, and its edge cases."""
import hashlib
import re

from llm_helpers import EDGE, docs_frame, small_documents
from pyspark.sql import functions as F

from sigshape.llm.exact_dedup import drop_copies, exact_groups


def brute(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", "", t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append((-len(t or ""), i is None, i))
    out = []
    for n, members in groups.items():
        keep = min(members, key=lambda m: (m[0], m[1], m[2] or 0))[2]
        left = 1
        for _, _, i in members:
            kept = i == keep and left > 0
            left -= kept
            out.append((i, keep, len(members), kept, hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def test_edges(spark):
    assert got(exact_groups(docs_frame(spark, EDGE))) == brute(EDGE)


def test_small_table(spark):
    docs = small_documents(spark)
    assert got(exact_groups(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_a_hash_collision_is_split_by_its_bytes(spark):
    rows = [(i, f"text {i % 7}") for i in range(40)]
    weak = lambda norm: F.unhex(F.substring(F.md5(norm), 1, 1))  # noqa: E731  16 hashes at most
    none = lambda norm: F.unhex(F.lit("00"))                     # noqa: E731  everything collides
    for digest in (weak, none):
        assert got(exact_groups(docs_frame(spark, rows), digest=digest)) == brute(rows)


def test_a_hot_group_and_an_empty_table(spark):
    rows = [(i, "same") for i in range(300)] + [(1000 + i, f"t{i}") for i in range(50)]
    assert got(exact_groups(docs_frame(spark, rows))) == brute(rows)
    assert got(exact_groups(docs_frame(spark, []))) == []


def test_dropping_keeps_columns_and_one_of_each(spark):
    docs = docs_frame(spark, EDGE)
    out = drop_copies(docs)
    assert out.schema == docs.schema
    kept = [(i, t) for i, t in EDGE if any(k for i2, _, _, k, _ in brute(EDGE) if i2 == i)]
    assert {r.doc_id for r in out.collect()} == {i for i, _ in kept}
    assert out.count() == len({re.sub(r"\s+", "", t or "") for _, t in EDGE})


def test_only_rows_with_a_partner_are_compared(spark, monkeypatch):
    """Many groups: the texts looked at are those of the groups, one copy of each, by either join."""
    import sigshape.llm.exact_dedup as m
    rows = [(i, f"text {i // 2 if i < 4000 else i}") for i in range(6000)]
    norm = spark.createDataFrame(rows, "doc_id long, norm string").withColumn("hash", m.content_md5(F.col("norm")))
    groups = norm.groupBy("hash").agg(F.count(F.lit(1)).alias("group_size"))
    for most in (m.PARTNER_GROUPS, 10):
        monkeypatch.setattr(m, "PARTNER_GROUPS", most)
        assert m._differing(norm, groups).count() == 0
        other = norm.unionByName(norm.where("doc_id = 0").withColumn("norm", F.lit("else")))
        assert m._differing(other, groups).count() == 1
        assert sorted(map(tuple, exact_groups(docs_frame(spark, rows[:50])).collect())) == sorted(
            (i, i - i % 2, 2, i % 2 == 0, __import__("hashlib").sha256(t.replace(" ", "").encode()).hexdigest()) for i, t in rows[:50])
    shuffled = norm.join(F.broadcast(groups.where("group_size > 1").select(F.xxhash64("hash").alias("of"))),
                         F.xxhash64("hash") == F.col("of"), "left_semi").count()
    assert shuffled == 4000
