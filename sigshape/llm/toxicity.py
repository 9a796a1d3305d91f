"""Toxicity: every significant toxic passage, by maximum-scoring segments.

Tokens are words and word beginnings (3 to 7 letters), each counted once in a
labelled text, so one text that repeats a word weighs no more than another.
The counts give each token a log-odds of the toxic against the other class
under a Dirichlet prior (the pooled frequencies, ``PRIOR`` of all tokens
strong); tokens whose z-score reaches ``MIN_Z`` form the model. A word scores by its most
significant token, every other word costs ``GAP``. One linear-time scan
finds all maximal-scoring segments of a text. A segment's score S becomes
bits above chance, ``lambda * S - ln(K * n)``, by the extreme-value law of
such segments in ordinary text of n words (lambda and K fitted on the other
class); the segments above chance are summed, and a logistic fit on the
training rows turns that sum into the score.

The fit reads at most ``PER_CLASS`` labelled rows of each class (documented
bound); the model holds tokens of ``MIN_COUNT`` texts there, so its size
is bounded too.

Defined cases: a null text is empty; an empty text has no passage; repeated
rows score alike; without labels every score is 0.5, with one class it is
that class's share; an empty table gives no rows; columns other than id
and text are never read.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf

from .common import held_out, saved, ship, slices, text_of
from .labelled import class_weights, fit_logistic, training_rows

PER_CLASS = 4000
PRIOR = 0.02
MIN_Z = 3.0
MIN_COUNT = 4
GAP = 0.08
TOXIC_AT = 0.3
BEGINNINGS = range(3, 8)
WORD_CACHE = 400_000

_WORD = re.compile(r"\w+")


def tokens(word: str) -> list[str]:
    """A word and its beginnings (marked with ``*``)."""
    return [word, *(word[:k] + "*" for k in BEGINNINGS if k < len(word))]


def segments(at: list[int], score: list[float], gap: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first word, last word, score) of a text
    whose words at positions ``at`` have the given scores and whose other
    words cost ``gap`` each. Linear time: a word is stacked once, merged once."""
    stack: list[list] = []          # [first, last, sum before, sum after, index of the next lower start below]
    total, last = 0.0, -1
    for i, s in zip(at, score):
        total -= gap * (i - last - 1)
        last = i
        before, total = total, total + s
        if s <= 0:
            continue
        cand = [i, i, before, total, -1]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= cand[2]:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= cand[3]:
                cand[4] = j
                stack.append(cand)
                break
            cand = [stack[j][0], cand[1], stack[j][2], cand[3], -1]
            del stack[j:]
    return [(f, e, after - before) for f, e, before, after, _ in stack]


@dataclass
class ToxicModel:
    odds: dict[str, tuple[float, float]]          # token: (log-odds, z)
    lam: float = 1.0
    log_k: float = 0.0
    bias: float = 0.0
    slope: float = 0.0
    known: dict[str, float] = field(default_factory=dict)

    def __getstate__(self):
        return {**self.__dict__, "known": {}}

    def word(self, w: str) -> float:
        """Log-odds of a word by its most significant token; 0 if it has none."""
        found = [self.odds[t] for t in tokens(w) if t in self.odds]
        return max(found, key=lambda x: abs(x[1]))[0] if found else 0.0

    def of(self, w: str) -> float:
        """``word``, remembered."""
        if len(self.known) > WORD_CACHE:
            self.known.clear()
        if w not in self.known:
            self.known[w] = self.word(w)
        return self.known[w]

    def passages(self, text: str) -> tuple[list[tuple[int, int, float]], int]:
        """(maximal segments, number of words)."""
        words = _WORD.findall(text.lower())
        if len(self.known) > WORD_CACHE:
            self.known.clear()
        known = self.known
        for w in set(words).difference(known):
            known[w] = self.word(w)
        hits = [(i, s) for i, s in enumerate([known[w] for w in words]) if s]
        return segments([i for i, _ in hits], [s for _, s in hits], GAP), len(words)

    def above_chance(self, found: list[tuple[int, int, float]], n: int) -> list[tuple[int, int, float]]:
        """Segments with what their score has above the law of chance."""
        floor = self.log_k + np.log(max(n, 1))
        return [(a, b, self.lam * s - floor) for a, b, s in found if self.lam * s > floor]

    def score(self, text: str) -> tuple[float, list[tuple[int, int]]]:
        found = self.above_chance(*self.passages(text))
        x = np.log1p(sum(s for _, _, s in found))
        p = 1 / (1 + np.exp(-np.clip(self.bias + self.slope * x, -40, 40)))
        return float(p), [(a, b + 1) for a, b, _ in found]


def log_odds(counts: DataFrame, totals: tuple[int, int]) -> DataFrame:
    """token, odds, z from ``counts`` (token, other, toxic: texts that hold it)
    and the ``totals`` of distinct words in the texts of both classes, under
    a Dirichlet prior of the pooled frequencies."""
    n_c, n_t = totals
    a0 = PRIOR * (n_c + n_t)
    a = F.lit(a0) * (F.col("other") + F.col("toxic")) / F.lit(float(n_c + n_t))
    t, c = F.col("toxic") + a, F.col("other") + a
    odds = F.log(t / (F.lit(n_t + a0) - t)) - F.log(c / (F.lit(n_c + a0) - c))
    return (counts.where(F.col("toxic") + F.col("other") >= MIN_COUNT)
            .select("token", odds.alias("odds"), (odds / F.sqrt(1 / t + 1 / c)).alias("z")))


def extreme_value(hits: np.ndarray, times: np.ndarray, words: list[int], best: list[float]) -> tuple[float, float]:
    """(lambda, ln K) of segments in ordinary texts: lambda solves
    E[exp(lambda * s)] = 1 over their words, of which ``hits`` are the scores
    that stand ``times`` times (every score the model can give counts as seen
    once more, so the root exists), K matches the mean of their best segments."""
    seen = times.sum()
    n = max(sum(words), seen + 1)

    def excess(lam: float) -> float:
        return float(((times * np.exp(np.minimum(lam * hits, 700))).sum() + (n - seen) * np.exp(-lam * GAP)) / n - 1)

    lo, hi = 1e-3, 50.0
    if not (hits > 0).any() or excess(hi) < 0:
        lam = hi
    elif excess(lo) > 0:
        lam = lo
    else:
        for _ in range(80):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if excess(mid) < 0 else (lo, mid)
        lam = lo
    y = [lam * b - np.log(max(w, 1)) for b, w in zip(best, words) if w]
    return lam, float(np.mean(y) - np.euler_gamma) if y else 0.0


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 per_class: int = PER_CLASS) -> ToxicModel:
    """Learns from labelled, not held-out rows. Counts are summed by Spark;
    the driver gets the significant tokens, a histogram of the scores that
    words can have, and two numbers of each training row."""
    ship(docs.sparkSession)
    rows, counts = training_rows(docs, labels, "toxic", per_class, id_col, text_col)
    if min(counts) == 0:
        share = 0.5 if sum(counts) == 0 else counts[1] / sum(counts)
        share = min(max(share, 1e-6), 1 - 1e-6)
        return ToxicModel({}, bias=float(np.log(share / (1 - share))))
    rows = saved(rows.select("text", "label"), "toxic-training")

    def count(batches):
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = set(_WORD.findall(text.lower()))
                seen[label][""] += len(words)
                seen[label].update({t for w in words for t in tokens(w)})
        names = list(seen[0].keys() | seen[1].keys())
        for at in range(0, len(names), 50_000):
            some = names[at:at + 50_000]
            yield pa.RecordBatch.from_pydict({"token": some, "other": pa.array([seen[0][x] for x in some], pa.int64()),
                                              "toxic": pa.array([seen[1][x] for x in some], pa.int64())})

    summed = (rows.mapInArrow(count, "token string, other bigint, toxic bigint")
              .groupBy("token").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic")))
    summed = summed.persist()
    total = summed.where("token = ''").first()
    n_c, n_t = (total.other, total.toxic) if total else (0, 0)
    kept = log_odds(summed.where("token <> ''"), (max(n_c, 1), max(n_t, 1))).where(F.abs("z") >= MIN_Z).collect()
    summed.unpersist()
    model = ToxicModel({r.token: (r.odds, r.z) for r in kept})

    def histogram(batches):
        """How often ordinary texts have words of each score but 0."""
        seen: Counter = Counter()
        for text in (t for batch in batches for part in slices(batch) for t in part.column(0).to_pylist()):
            seen.update(s for w in _WORD.findall(text.lower()) if (s := model.of(w)))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.float64()), pa.array(list(seen.values()), pa.int64())], ["s", "n"])

    def best(batches):
        """The number of words and the best segment of every text."""
        for part in (p for batch in batches for p in slices(batch)):
            got = [model.passages(t) for t in part.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(1), pa.array([n for _, n in got], pa.int64()),
                 pa.array([max((s for _, _, s in found), default=0.0) for found, _ in got], pa.float64())], ["label", "words", "best"])

    ordinary = rows.where("label = 0")
    seen = {r.s: r.n for r in ordinary.mapInArrow(histogram, "s double, n bigint").groupBy("s").agg(F.sum("n").alias("n")).collect()}
    possible = sorted({o for o, _ in model.odds.values()})
    hits = np.array(sorted(seen.keys() | set(possible)), float)
    times = np.array([seen.get(s, 0) + (s in set(possible)) for s in hits], float)
    got = ordinary.mapInArrow(best, "label int, words bigint, best double").collect()
    model.lam, model.log_k = extreme_value(hits, times, [r.words for r in got], [r.best for r in got])

    def above(batches):
        """What every text's passages have above chance."""
        for part in (p for batch in batches for p in slices(batch)):
            x = [float(np.log1p(sum(s for _, _, s in model.above_chance(*model.passages(t))))) for t in part.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(1), pa.array(x, pa.float64())], ["label", "x"])

    got = rows.mapInArrow(above, "label int, x double").collect()
    x = np.array([r.x for r in got])
    y = np.array([r.label for r in got], float)
    model.bias, model.slope = fit_logistic(x, y, class_weights(y, counts))
    return model


def toxic_passages(model: ToxicModel, text: Column) -> Column:
    """struct(score, passages) of a text column; a passage is first:end in words."""
    @arrow_udf("struct<score: double, passages: string>")
    def score(texts: pa.Array) -> pa.Array:
        got = [model.score(t) for part in slices(texts) for t in part.to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array([p for p, _ in got], pa.float64()),
             pa.array([",".join(f"{a}:{b}" for a, b in spans) for _, spans in got], pa.string())],
            names=["score", "passages"])

    return score(text_of(text))


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, passages."""
    model = fit_toxicity(docs, labels, id_col, text_col)
    return (docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"),
                        toxic_passages(model, F.col(text_col)).alias("t"))
            .select("doc_id", "held_out", "t.score", (F.col("t.score") >= TOXIC_AT).cast("int").alias("predicted"),
                    "t.passages"))
