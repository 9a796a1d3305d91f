"""Quality classifier: held-out accuracy, determinism, edge cases."""
import zlib

import numpy as np
import pytest
from llm_helpers import EDGE, docs_frame

from sigshape.llm.common import held_out
from sigshape.llm.quality import CHUNK, QualityModel, features, hashed, keep_good, packed, score_quality

SF = "/root/testdata/sf0.01"
LABELS = "doc_id bigint, quality int, toxic int"


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, score_quality(docs, labels).collect()


def test_held_out_accuracy(scored):
    docs, labels, out = scored
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert len(out) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    tested = [r for r in out if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in tested]) > 0.95
    clean = [r for r in tested if truth[r.doc_id] == 1]
    assert np.mean([r.predicted for r in clean]) > 0.97


def test_scores_never_depend_on_held_out_labels(spark, scored):
    docs, labels, out = scored
    flipped = labels.withColumn("quality", (1 - labels["quality"])).where(held_out())
    other = score_quality(docs, labels.where(~held_out()).unionByName(flipped)).collect()
    assert {r.doc_id: r.score for r in other} == {r.doc_id: r.score for r in out}


def test_keeping_is_the_same_decision(scored):
    docs, labels, out = scored
    kept = keep_good(docs, labels)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {r.doc_id for r in out if r.predicted}


@pytest.mark.parametrize("labels,score", [([], 0.5), ([(1, 1, 0), (2, 1, 0)], 1.0), ([(None, 1, 1), (1, None, None)], 0.5)])
def test_edges_without_two_classes(spark, labels, score):
    out = score_quality(docs_frame(spark, EDGE), spark.createDataFrame(labels, LABELS)).collect()
    assert len(out) == len(EDGE) and all(abs(r.score - score) < 1e-5 for r in out)
    assert score_quality(docs_frame(spark, []), spark.createDataFrame(labels, LABELS)).collect() == []


def test_edges_with_a_fit(spark):
    labels = [(i, int(i != 7), 0) for i in (1, 2, 3, 4, 5, 6, 7, 8)]
    out = score_quality(docs_frame(spark, EDGE), spark.createDataFrame(labels * 2, LABELS)).collect()
    assert len(out) == len(EDGE) and all(0 <= r.score <= 1 for r in out)
    assert len({r.score for r in out if r.doc_id == 4}) == 1


def code_points(t):
    return np.array([ord(c) for c in t], np.uint32)


def test_features_by_hand():
    one = np.zeros(1, np.int64)
    found = [at.tolist() for at, _ in hashed(code_points(" ab abc "), one)]
    # 3 characters: " ab", "ab ", " ab", "abc", "bc "; 4: " ab ", " abc", "abc "; 5: " abc "; words; repeats
    assert found == [[0, 1, 3, 4, 5], [0, 3, 4], [3], [1, 4], []]
    assert [at.tolist() for at, _ in hashed(code_points(" éß 日本語 "), one)] == found    # characters, not bytes
    assert features("x x")[1].sum() == 2 + 2 + 1                                    # " x " twice, "x" twice, one repeat
    assert features("")[1].sum() == 0 and features("a")[1].sum() == 2               # " a " and "a"
    assert features("ab\tcd\x0bab")[1].tolist() == features("ab cd ab")[1].tolist()


def plain_features(t):
    """n-grams of 3 to 5 characters that hold no blank but at their ends, and words."""
    s = " " + "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in t) + " "
    out = [s[i:i + n] for n in (3, 4, 5) for i in range(len(s) - n + 1) if " " not in s[i + 1:i + n - 1]]
    words = [w for w in s.split(" ") if w]
    return out + [("word", w) for w in words] + ["twice" for a, b in zip(words, words[1:]) if a == b]


@pytest.mark.parametrize("text", ["", "a", "ab ab", " two  blanks ", "日本語 é\u0301 😀😀 x", "tab\tline\nend\r", "a\u00a0b"])
def test_features_are_those_of_the_plain_list(text):
    from collections import Counter
    assert sorted(features(text)[1].tolist()) == sorted(Counter(plain_features(text)).values())


def test_scores_equal_the_plain_average(spark):
    """The score of a text is the logistic of the mean of its features' numbers."""
    rng = np.random.default_rng(3)
    model = QualityModel(rng.normal(size=1 << 17).astype(np.float32), -0.2, 2.0)
    texts = ["some words of prose", "日本語 and é", "", "a b  c\n\td", "word " * 300]
    for t, got in zip(texts, model.scores(texts)):
        rows, n = features(t)
        assert n.sum() == len(plain_features(t))
        mean = float((model.weight[rows].astype(float) * n).sum() / max(1, n.sum()))
        assert got == pytest.approx(1 / (1 + np.exp(0.2 - 2 * mean)), rel=1e-6)


def test_a_text_scores_the_same_in_any_batch():
    rng = np.random.default_rng(0)
    model = QualityModel(rng.normal(size=1 << 17).astype(np.float32), 0.1, 3.0)
    texts = ["same word word", "", "word word", "é" * 9, "x " * 1000, "word", "word " * (CHUNK // 4)]
    assert np.allclose(model.scores(texts), [model.scores([t])[0] for t in texts], rtol=1e-9)
    assert sum(len(g) for g, _, _ in packed(texts)) == len(texts) + 1      # the long text is cut once


def test_a_sampled_id_is_one_row_and_absent_ids_use_nothing_up(spark):
    from sigshape.llm.labelled import training_rows
    docs = docs_frame(spark, [(1, "b text"), (1, "a text"), *[(1, "b text")] * 40, (3, "clean"), (3, "clean"), (None, "x"), (4, None)])
    labels = spark.createDataFrame([(1, 0, 0), (3, 1, 0), (4, 1, 0), *[(100 + i, 1, 0) for i in range(50)]], LABELS)
    rows, counts = training_rows(docs, labels, "quality", 2)
    got = sorted((r.doc_id, r.label) for r in rows.collect())
    assert got == [(1, 0), (3, 1), (4, 1)] and counts == (1, 2)
    assert {r.text for r in rows.collect() if r.doc_id == 1} <= {"a text", "b text"}
