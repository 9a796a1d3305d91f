"""Quality rules: counts by brute force, the learner on planted rules, held-out rows."""
import random
import re

import numpy as np
import pytest
from llm_helpers import EDGE, SF_SMALL, docs_frame
from pyspark.sql import functions as F

from sigshape.llm.common import held_out
from sigshape.llm.queries import QUERIES
from sigshape.llm.quality_rules import (COUNTS, Condition, best_condition, count_text, first_rule, holds, learn_rules,
                                        prune, quality_rules, statistics)

SF = "/root/testdata/sf0.01"
LABELS = "doc_id bigint, quality int, toxic int"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    every = "".join(words)
    return (len(words), len(every), len(re.findall(r"[#*$%&|<>]", text)), sum(x in lines[:i] for i, x in enumerate(lines)), len(hit))


def random_text(rng):
    pool = rng.choice([["a", "b"], ["x", "é", "#&", "Ab1", "<>", "日本", "😀"], [f"w{i}" for i in range(40)]])
    out = "".join(rng.choice(pool) + rng.choice([" ", " ", " ", "\n", "\t", "\x0b", "\x0c", "\r", "\x1c", "\xa0", "\x85"]) for _ in range(rng.randint(0, 60)))
    return out * rng.choice([1, 1, 2, 3])


@pytest.mark.parametrize("seed", range(8))
def test_counts(seed):
    rng = random.Random(seed)
    for _ in range(40):
        t = random_text(rng)
        got = count_text(t)
        assert got[:5] == brute(t)
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        assert got[9] == len(set(words)) and got[10] == sum(not any(c.isalnum() for c in w) for w in words)
        assert got[6:8] == (sum(c.isupper() for c in t), sum(c.isdigit() for c in t))


def test_repeats_by_hand():
    eight = " ".join("abcdefgh")
    assert count_text(eight + " " + eight)[4] == 16 and count_text(eight + " x " + eight)[4] == 16
    assert count_text("a " * 9)[4] == 9 and count_text("a " * 8)[4] == 0


def test_best_condition_is_the_best_of_all():
    rng = np.random.default_rng(5)
    for _ in range(20):
        x = rng.integers(0, 6, (40, 2)).astype(float)
        low = (x[:, 0] > 3) ^ (rng.random(40) < 0.2)
        w = rng.random(40) + 0.5
        if low.all() or not low.any():
            continue

        def gain(on):
            p, n = w[on & low].sum(), w[on & ~low].sum()
            return p * (np.log2(p / (p + n)) - np.log2(w[low].sum() / w.sum())) if p else 0.0

        every = [Condition(s, up, t + 0.5) for s in "ab" for up in (True, False) for t in range(5)]
        best = max(gain(c.holds(x, ["a", "b"])) for c in every)
        found = best_condition(x, low, w, ["a", "b"])
        assert found is not None and abs(gain(found.holds(x, ["a", "b"])) - best) < 1e-9


def test_planted_rules_are_found():
    rng = np.random.default_rng(1)
    x = rng.random((1500, 4))
    low = ((x[:, 0] >= 0.9) | ((x[:, 1] <= 0.3) & (x[:, 2] >= 0.8)))
    rules = learn_rules(x, low, np.ones(len(x)), list("abcd"))
    said = np.zeros(len(x), bool)
    for r in rules:
        said |= holds(r, x, list("abcd"))
    assert (said == low).mean() > 0.98 and len(rules) <= 6 and max(map(len, rules)) <= 3
    assert learn_rules(x, rng.random(1500) < 0.1, np.ones(1500), list("abcd")) == []       # noise alone: no precise rule


def test_pruning_drops_what_does_not_help():
    x = np.array([[i / 10, 0.0 if i % 2 else 1.0] for i in range(20)])
    low = x[:, 0] >= 1.0
    good, useless = Condition("a", True, 1.0), Condition("b", True, 0.5)
    assert prune((good, useless), x, low, np.ones(20), ["a", "b"]) == (good,)


def test_the_expression_is_the_list(spark):
    rules = [(Condition("words", True, 30.0), Condition("word_length", False, 1.5)), (Condition("symbols_per_character", True, 0.5),)]
    rows = [(30, 45, 0), (30, 46, 0), (2, 4, 2), (2, 4, 1), (30, 45, 45), (0, 0, 0)]
    df = spark.createDataFrame([(*r, 0, 0, 1, 0, 0, 0, 1, 0) for r in rows], ", ".join(f"{c} bigint" for c in COUNTS))
    got = df.select("*", *[c.alias(n) for n, c in statistics().items()]).select(first_rule(rules).alias("k")).collect()
    assert [r.k for r in got] == [1, 0, 2, 0, 1, 0]


def test_query_on_held_out_rows(spark):
    out = QUERIES["op13_quality_rules"](spark, SF)
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").where(held_out()).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = out.collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r[c] for c in COUNTS[:5]) == brute(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed and r.rule is None)
    tested = [r for r in rows if r.doc_id in truth and not r.base_failed]
    assert all(r.kept for r in tested if truth[r.doc_id] == 1)
    assert np.mean([not r.kept for r in tested if truth[r.doc_id] == 0]) > 0.9


def test_held_out_labels_are_never_learned(spark):
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.where(held_out()).withColumn("quality", 1 - F.col("quality"))
    assert (sorted(map(repr, quality_rules(docs, labels).collect()))
            == sorted(map(repr, quality_rules(docs, labels.where(~held_out()).unionByName(flipped)).collect())))


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, 1, 0)], [(None, 1, 1), (1, None, None)], [(4, 0, 0), (4, 1, 0), (7, 0, 0), (8, 1, 1)] * 2])
def test_edges(spark, labels):
    out = quality_rules(docs_frame(spark, EDGE), spark.createDataFrame(labels, LABELS)).collect()
    assert sorted((repr(r.doc_id), r.n_words) for r in out) == sorted((repr(i), brute(t if len(t or "") < 1000 else "")[0] or len((t or "").split()))
                                                                     for i, t in EDGE)
    assert not any(r.kept for r in out)            # all short, or one word over and over
    assert quality_rules(docs_frame(spark, []), spark.createDataFrame(labels, LABELS)).collect() == []
