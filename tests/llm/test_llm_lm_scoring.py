"""LM scoring: chances sum to one, scores equal a plain computation."""
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_helpers import EDGE, docs_frame, small_documents, SF_SMALL

import sigshape.llm.lm_scoring as m

LABELS = "doc_id bigint, quality int, toxic int"


def test_arrays_come_back_from_their_bytes():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 1000):
        x = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
        assert (m._unpack_rising(m._pack_rising(x)) == x).all()
        y = rng.integers(-5, 1 << 40, n)
        assert (m._unpack(m._pack(y), np.int64) == y).all()


@pytest.mark.parametrize("buckets", [1, 2, 7])
def test_pieces_cover_the_hashes(buckets):
    ids = np.array([0, 1, 2, 1 << 62, (1 << 63) + 5, (1 << 64) - 1], np.uint64)
    rows = m._asks(9, buckets, ids, [np.arange(6)])
    assert [r[0] for r in rows] == sorted({int(i) // -(-(1 << 64) // buckets) for i in ids})
    assert np.concatenate([m._unpack_rising(r[2]) for r in rows]).tolist() == ids.tolist()
    assert np.concatenate([m._unpack(r[3], np.int64) for r in rows]).tolist() == list(range(6))


def plain_scores(rows, good):
    """The documented models at the registered floors, from strings and dictionaries alone."""
    import re
    texts = [(i, re.findall(r"\w+", (t or "").lower())) for i, t in rows]
    n = Counter(x for _, w in texts for x in w)
    ids = {w for w, k in n.items() if k >= 2}
    size = len(ids) + 2                                   # the unknown word and the start
    code = lambda w: ["<s>", *[x if x in ids else "?" for x in w]]
    models = []
    target_size = sum(len(w) for i, w in texts if i in good) or sum(len(w) for _, w in texts)
    for docs in ([w for _, w in texts], [w for i, w in texts if i in good] or [w for _, w in texts]):
        pairs = Counter(p for w in docs for p in zip(code(w), code(w)[1:]))
        scale = target_size / max(sum(pairs.values()), 1)
        one = Counter(x for w in docs for x in code(w)[1:])
        one["<s>"] = sum(k for (a, _), k in pairs.items() if a == "<s>")
        kept = {p: k * scale for p, k in pairs.items() if k >= 2}
        sums, taken = defaultdict(float), defaultdict(float)
        for (a, _), k in kept.items():
            sums[a] += k
            taken[a] += k - min(0.5, k / 2)
        norm = sum(one.values()) * scale + size

        def loss(a, b, kept=kept, one=one, scale=scale, sums=sums, taken=taken, norm=norm):
            single = (one[b] * scale + 1) / norm
            begun = max(one[a] * scale, 1e-9, sums[a])
            back = min(max(1 - taken[a] / begun, 1e-6), 1.0)
            k = kept.get((a, b), 0)
            return -math.log(back * single + (k - min(0.5, k / 2)) / begun)
        models.append(loss)
    out = {}
    for i, w in texts:
        x = code(w)
        out[i, len(w)] = [sum(f(a, b) for a, b in zip(x, x[1:])) / max(1, len(w)) for f in models]
    return out


def same(out, want):
    for r in out:
        background, target = want[r.doc_id, r.n_tokens]
        assert r.background_loss == pytest.approx(background, rel=1e-9, abs=1e-9)
        assert r.target_loss == pytest.approx(target, rel=1e-9, abs=1e-9)
        assert r.score == pytest.approx(r.target_loss - r.background_loss)


@pytest.mark.parametrize("tokens,bucket", [(5000, 7000), (1 << 20, 3 << 20)])
def test_scores_equal_the_plain_computation(spark, monkeypatch, tokens, bucket):
    """Also over many chunks and buckets."""
    docs = small_documents(spark)
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    monkeypatch.setattr(m, "CHUNK_TOKENS", tokens)
    monkeypatch.setattr(m, "BUCKET_TOKENS", bucket)
    import zlib
    good = {r.doc_id for r in labels.collect() if r.quality == 1 and zlib.crc32(str(r.doc_id).encode()) % 4 != 2}
    out = m.score_documents(docs, labels).collect()
    assert len(out) == docs.count()
    same(out, plain_scores([(r.doc_id, r.text) for r in docs.collect()], good))


@pytest.mark.parametrize("seed", range(3))
def test_random_texts_of_few_words(spark, seed):
    """Words that stand once next to one another, at either end, and in copies of a text."""
    rng = random.Random(seed)
    texts = [" ".join(rng.choice(["a", "b", "c", f"once{i}{k}"]) for k in range(rng.randint(0, 7))) for i in range(40)]
    rows = list(enumerate(texts + texts[:5] + ["only", "", None, "x y z"]))
    good = set(rng.sample(range(45), 20)) if seed else set()
    good = {i for i in good if __import__("zlib").crc32(str(i).encode()) % 4 != 2}
    labels = spark.createDataFrame([(i, 1, 0) for i in good], LABELS)
    same(m.score_documents(docs_frame(spark, rows), labels).collect(), plain_scores(rows, good))


def test_target_like_documents_score_lower(spark):
    rows = [(i, "alpha beta gamma delta " * 5 if i % 2 else "one two three four " * 5) for i in range(60)]
    out = m.score_documents(docs_frame(spark, rows), spark.createDataFrame([(i, i % 2, 0) for i in range(60)], LABELS)).collect()
    assert max(r.score for r in out if r.doc_id % 2) < min(r.score for r in out if not r.doc_id % 2)


def test_edges(spark):
    for labels in ([], [(4, 1, 0), (4, 1, 0), (None, 1, 0), (7, None, None)]):
        out = m.score_documents(docs_frame(spark, EDGE), spark.createDataFrame(labels, LABELS)).collect()
        assert len(out) == len(EDGE)
        assert all(r.score == 0 and r.n_tokens == 0 for r in out if r.doc_id in (1, 2, 3))
        assert labels or all(abs(r.score) < 1e-12 for r in out)
    assert m.score_documents(docs_frame(spark, []), spark.createDataFrame([], LABELS)).collect() == []


def test_models_keep_what_stands_twice_in_a_large_corpus(spark):
    filler = "alpha beta gamma delta " * 25_000
    rare = "zeta eta theta iota"                      # three times in 2 M tokens
    rows = [(i, filler) for i in range(20)] + [(100 + i, rare) for i in range(3)] + [(200, "kappa lambda omikron rho")]
    docs = docs_frame(spark, rows)
    labels = spark.createDataFrame([(0, 1, 0), (1, 1, 0), (100, 1, 0), (101, 1, 0), (102, 0, 0)], LABELS)
    out = {r.doc_id: r for r in m.score_documents(docs, labels).collect()}
    assert out[100].background_loss < out[200].background_loss - 1
    same(out.values(), plain_scores(rows, {0, 1, 100, 101} - {i for i in (0, 1, 100, 101) if __import__("zlib").crc32(str(i).encode()) % 4 == 2}))
