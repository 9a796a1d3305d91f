"""Toxicity: segments against brute force, held-out accuracy, edge cases."""
import random

import numpy as np
import pytest
from llm_helpers import EDGE, docs_frame

from sigshape.llm.toxicity import GAP, extreme_value, score_toxicity, segments

LABELS = "doc_id bigint, quality int, toxic int"


def brute_segments(scores):
    """Ruzzo and Tompa's definition: take the best segment (the shortest of
    equals), then go on left and right of it."""
    best = None
    for a in range(len(scores)):
        total = 0.0
        for b in range(a, len(scores)):
            total += scores[b]
            if total > 1e-12 and (best is None or total > best[2] + 1e-9 or (abs(total - best[2]) <= 1e-9 and b - a < best[1] - best[0])):
                best = (a, b, total)
    if best is None:
        return []
    a, b, s = best
    right = [(x + b + 1, y + b + 1, z) for x, y, z in brute_segments(scores[b + 1:])]
    return brute_segments(scores[:a]) + [best] + right


@pytest.mark.parametrize("seed", range(25))
def test_segments(seed):
    rng = random.Random(seed)
    scores = [rng.choice([-GAP, -GAP, -GAP, rng.uniform(0.01, 1), -rng.uniform(0.2, 1)]) for _ in range(rng.randint(0, 50))]
    hits = [(i, s) for i, s in enumerate(scores) if s != -GAP]
    got = segments([i for i, _ in hits], [s for _, s in hits], GAP)
    want = brute_segments(scores)
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
    assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_extreme_value_root():
    lam, _ = extreme_value(np.array([1.0, 2.0]), np.array([1.0, 1.0]), [1000], [2.0])
    total = np.exp(lam * 1.0) + np.exp(lam * 2.0) + 998 * np.exp(-lam * GAP)
    assert abs(total / 1000 - 1) < 1e-6


def plain_scores(docs, truth):
    """The documented classifier in one process, over lists and dictionaries."""
    import math
    import re
    import zlib
    from collections import Counter

    from sigshape.llm.labelled import class_weights, fit_logistic
    words_of = lambda t: re.findall(r"\w+", (t or "").lower())
    tokens = lambda w: [w, *(w[:k] + "*" for k in range(3, 8) if k < len(w))]
    known = [(t, truth[i]) for i, t in docs if i in truth and zlib.crc32(str(i).encode()) % 4 != 2]
    counts, n = (Counter(), Counter()), [0, 0]
    for t, y in known:
        words = set(words_of(t))
        n[y] += len(words)
        counts[y].update({x for w in words for x in tokens(w)})
    a0 = 0.02 * sum(n)
    odds = {}
    for x in counts[0].keys() | counts[1].keys():
        c, t = counts[0][x], counts[1][x]
        if c + t >= 4:
            a = a0 * (c + t) / sum(n)
            o = math.log((t + a) / (n[1] + a0 - t - a)) - math.log((c + a) / (n[0] + a0 - c - a))
            z = o / math.sqrt(1 / (t + a) + 1 / (c + a))
            if abs(z) >= 3:
                odds[x] = (o, z)

    def word(w):
        found = [odds[x] for x in tokens(w) if x in odds]
        return max(found, key=lambda v: abs(v[1]))[0] if found else 0.0

    def found(t):
        scores = [word(w) or -GAP for w in words_of(t)]
        return [s for *_, s in brute_segments(scores)] if any(s > 0 for s in scores) else [], len(scores)

    plain = [t for t, y in known if y == 0]
    hits = [s for t in plain for w in words_of(t) if (s := word(w))] + sorted({o for o, _ in odds.values()})
    got = [found(t) for t in plain]
    lam, log_k = extreme_value(np.array(hits), np.ones(len(hits)), [k for _, k in got], [max(s, default=0.0) for s, _ in got])

    def x_of(t):
        s, k = found(t)
        floor = log_k + math.log(max(k, 1))
        return math.log1p(sum(lam * v - floor for v in s if lam * v > floor))

    y = np.array([y for _, y in known], float)
    bias, slope = fit_logistic(np.array([x_of(t) for t, _ in known]), y, class_weights(y, (len(plain), len(known) - len(plain))))
    return {i: 1 / (1 + math.exp(-(bias + slope * x_of(t)))) for i, t in docs}


def test_scores_equal_the_plain_computation(spark):
    rng = random.Random(6)
    plain = [f"w{i}" for i in range(60)]
    rows, truth = [], {}
    for i in range(160):
        words = [rng.choice(plain) for _ in range(rng.randint(1, 25))]
        if i % 5 == 0:
            at = rng.randint(0, len(words))
            words[at:at] = [rng.choice(["badone", "badtwo", "Badthree,"]) for _ in range(3)]
        rows.append((i, " ".join(words)))
        if i % 7:
            truth[i] = int(i % 5 == 0)
    rows += [(500, None), (501, "badone")]
    labels = spark.createDataFrame([(i, 1, y) for i, y in truth.items()], LABELS)
    want = plain_scores(rows, truth)
    for r in score_toxicity(docs_frame(spark, rows + rows[:3]), labels).collect():
        assert abs(r.score - want[r.doc_id]) < 1e-6


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    out = score_toxicity(docs, labels).collect()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    assert len(out) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
    tested = [r for r in out if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in tested]) > 0.9


@pytest.mark.parametrize("labels,score", [([], 0.5), ([(1, 1, 0), (2, 1, 0)], 0.0), ([(None, 1, 1), (1, None, None)], 0.5)])
def test_edges_without_two_classes(spark, labels, score):
    out = score_toxicity(docs_frame(spark, EDGE), spark.createDataFrame(labels, LABELS)).collect()
    assert len(out) == len(EDGE) and all(abs(r.score - score) < 1e-5 and r.passages == "" for r in out)
    assert score_toxicity(docs_frame(spark, []), spark.createDataFrame(labels, LABELS)).collect() == []


def test_planted_passages_are_found(spark):
    rng = random.Random(0)
    plain = [f"w{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(400):
        words = [rng.choice(plain) for _ in range(80)]
        if i % 4 == 0:
            at = rng.randint(5, 60)
            words[at:at + 4] = [rng.choice(["badone", "badtwo", "badthree"]) for _ in range(4)]
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 4 == 0)))
    out = score_toxicity(docs_frame(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    assert np.mean([r.predicted == (r.doc_id % 4 == 0) for r in out]) > 0.99
    text = dict(rows)
    for r in out:
        if r.doc_id % 4 == 0:
            spans = [tuple(map(int, s.split(":"))) for s in r.passages.split(",")]
            words = text[r.doc_id].split()
            inside = [w for a, b in spans for w in words[a:b]]
            assert sum(w.startswith("bad") for w in inside) == 4
