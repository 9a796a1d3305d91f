"""Quality rules: a learned decision list over text statistics.

Every text is counted once (``text_counts``); the statistics are plain ratios
of those counts. Sequential covering learns rules for the texts labelled of
low quality: a rule grows by the threshold that gains most information on two
thirds of the labelled rows, and is then pruned from its end on the other
third; it joins the list if it is precise there, what it covers leaves both
parts, and the next one starts. The list becomes one ordered Spark conditional
expression over the statistics: the first rule that holds rejects a text, and
a text that no rule covers stays.

A fixed base rule comes first: fewer than ``MIN_WORDS`` words, or over 30 % of
the words in ``SPAN``-word windows that the text holds twice or more.

The fit reads the statistics (a dozen numbers) of at most ``PER_CLASS``
labelled rows of each class, the first by a hash of the id; held-out rows
never take part. Texts are counted where they are, in slices of a batch.

Defined cases: a null or empty text has no words and fails the base rule;
ratios of nothing are 0; a document labelled more than once has its majority
label, null labels do not count; of rows of one id the one with the least
counts is learned from; without rows of both classes there are no rules;
repeated rows have equal results; an empty table gives no rows; columns other
than id and text are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_out, saved, ship, slices, text_of
from .labelled import class_weights

MIN_WORDS = 20
MAX_REPEATED = 30             # percent of the words
SPAN = 8                      # words of a window that must not repeat
#: Labelled rows of each class that the fit reads at most.
PER_CLASS = 4000
#: Share of low-quality rows among those that a rule covers, on rows it did not grow on.
PRECISION = 0.95
#: Rows that a rule must cover in all, and conditions and rules at most.
LEAST_COVER, MAX_CONDITIONS, MAX_RULES = 5, 4, 32

SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_upper", "n_digits", "n_marks", "n_distinct", "n_bare")
_PIECE = 1 << 20              # characters that are classed at once


def statistics() -> dict[str, Column]:
    """The statistics that conditions may name, from the counts."""
    def share(part: str, whole: str) -> Column:
        return F.coalesce(F.col(part).cast("double") / F.nullif(F.col(whole).cast("double"), F.lit(0.0)), F.lit(0.0))

    return {
        "words": F.col("n_words").cast("double"),
        "word_length": share("word_chars", "n_words"),
        "symbols_per_character": share("n_symbols", "word_chars"),
        "upper_per_character": share("n_upper", "word_chars"),
        "digits_per_character": share("n_digits", "word_chars"),
        "marks_per_character": share("n_marks", "word_chars"),
        "bare_per_word": share("n_bare", "n_words"),
        "distinct_per_word": share("n_distinct", "n_words"),
        "repeated_per_word": share("n_repeat_words", "n_words"),
        "dup_lines_per_line": share("n_dup_lines", "n_lines"),
        "words_per_line": share("n_words", "n_lines"),
    }


@cache
def _classes() -> np.ndarray:
    """Class of a code point: 0 white space, 1 symbol, 2 upper case, 3 digit,
    4 other mark, 5 the rest (all code points beyond the first plane)."""
    out = np.full(1 << 16, 5, np.uint8)
    for c in range(1 << 16):
        x = chr(c)
        if x in " \t\n\v\f\r":
            out[c] = 0
        elif x in SYMBOLS:
            out[c] = 1
        elif x.isupper():
            out[c] = 2
        elif x.isdigit():
            out[c] = 3
        elif not x.isalpha():
            out[c] = 4
    return out


def repeated_words(words: list[bytes], span: int = SPAN) -> int:
    """Words in windows of ``span`` words that stand twice or more."""
    if len(words) <= span:
        return 0
    ids: dict[bytes, int] = {}
    x = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    if len(ids) == len(words):
        return 0
    # Ranks of ever longer windows: two overlapping ones make the next.
    n, have = len(words), 1
    while have < span:
        step = min(have, span - have)
        _, x = np.unique(x[:n - have - step + 1] * np.int64(n + 1) + x[step:n - have + 1], return_inverse=True)
        have += step
    again = np.bincount(x)[x] > 1
    if not again.any():
        return 0
    edges = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + span, -1)
    return int((np.cumsum(edges)[:n] > 0).sum())


def count_text(text: str) -> tuple[int, ...]:
    """The counts of one whole text, in the order of ``COUNTS``."""
    words = text.encode("utf-8", "replace").split()         # bytes split at [\x20\x09-\x0D]
    kinds = np.zeros(6, np.int64)
    for at in range(0, len(text), _PIECE):
        points = np.frombuffer(text[at:at + _PIECE].encode("utf-32-le", "replace"), np.uint32)
        kinds += np.bincount(_classes()[np.minimum(points, 0xFFFF)], minlength=6)
    seen: set[str] = set()
    n_lines = n_dup = 0
    for line in text.split("\n"):
        if line.strip(" \t\v\f\r"):
            n_lines += 1
            n_dup += line in seen
            seen.add(line)
    distinct = set(words)
    bare = {w for w in distinct if not any(c.isalnum() for c in w.decode("utf-8", "replace"))} if kinds[1] + kinds[4] else set()
    n_bare = sum(w in bare for w in words) if bare else 0
    return (len(words), len(text) - int(kinds[0]), int(kinds[1]), n_dup, repeated_words(words), n_lines,
            int(kinds[2]), int(kinds[3]), int(kinds[4]), len(distinct), n_bare)


def text_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, the ``COUNTS``) of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    ship(docs.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            got = [count_text(t) for t in batch.column(1).to_pylist()]
            columns = list(zip(*got)) or [()] * len(COUNTS)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in columns]], ["doc_id", *COUNTS])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(counted, f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in COUNTS))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED)


@dataclass(frozen=True)
class Condition:
    statistic: str
    at_least: bool
    threshold: float

    def holds(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        column = x[:, names.index(self.statistic)]
        return column >= self.threshold if self.at_least else column <= self.threshold

    def column(self) -> Column:
        c = F.col(self.statistic)
        return c >= self.threshold if self.at_least else c <= self.threshold

    def __str__(self) -> str:
        return f"{self.statistic} {'>=' if self.at_least else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


def holds(rule: Rule, x: np.ndarray, names: list[str]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for c in rule:
        out &= c.holds(x, names)
    return out


def best_condition(x: np.ndarray, low: np.ndarray, weight: np.ndarray, names: list[str]) -> Condition | None:
    """The threshold with the greatest gain: the weight of the low rows kept,
    times how much purer they are (in bits). Thresholds lie midway between values."""
    def bits(p: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.log2(np.maximum(p, 1e-12) / np.maximum(p + n, 1e-12))

    p_all, n_all = weight[low].sum(), weight[~low].sum()
    best, found = 1e-9, None
    for j, name in enumerate(names):
        order = np.argsort(x[:, j], kind="stable")
        v, w, is_low = x[order, j], weight[order], low[order]
        cuts = np.flatnonzero(v[1:] > v[:-1])
        if not len(cuts):
            continue
        p, n = np.cumsum(w * is_low)[cuts], np.cumsum(w * ~is_low)[cuts]
        for at_least, pp, nn in ((False, p, n), (True, p_all - p, n_all - n)):
            gain = np.where(pp > 0, pp * (bits(pp, nn) - bits(p_all, n_all)), 0.0)
            k = int(gain.argmax())
            if gain[k] > best:
                lo, hi = v[cuts[k]], v[cuts[k] + 1]
                mid = lo + (hi - lo) / 2
                best, found = gain[k], Condition(name, at_least, float(mid if lo < mid < hi else hi if at_least else lo))
    return found


def grow(x: np.ndarray, low: np.ndarray, weight: np.ndarray, names: list[str]) -> Rule:
    """Conditions, one by one, until no other row is covered or none helps."""
    rule: Rule = ()
    while len(rule) < MAX_CONDITIONS and (~low).any():
        c = best_condition(x, low, weight, names)
        if c is None:
            break
        rule += (c,)
        on = c.holds(x, names)
        x, low, weight = x[on], low[on], weight[on]
    return rule


def prune(rule: Rule, x: np.ndarray, low: np.ndarray, weight: np.ndarray, names: list[str]) -> Rule:
    """The shortest head of the rule with the best balance on other rows."""
    def worth(k: int) -> float:
        on = holds(rule[:k], x, names)
        p, n = weight[on & low].sum(), weight[on & ~low].sum()
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (round(worth(len(r)), 12), -len(r)), default=())


def learn_rules(x: np.ndarray, low: np.ndarray, weight: np.ndarray, names: list[str]) -> list[Rule]:
    """The ordered rules; rows are dealt to the two parts in turn."""
    rules: list[Rule] = []
    other = np.arange(len(x)) % 3 == 2
    left = np.ones(len(x), bool)
    while len(rules) < MAX_RULES and (low & left & ~other).any():
        a, b = left & ~other, left & other
        rule = prune(grow(x[a], low[a], weight[a], names), x[b], low[b], weight[b], names)
        if not rule:
            break
        on = holds(rule, x, names)
        p, n = weight[on & b & low].sum(), weight[on & b & ~low].sum()
        if p == 0 or p < PRECISION * (p + n) or (on & left & low).sum() < LEAST_COVER:
            break
        rules.append(rule)
        left &= ~on
    return rules


def first_rule(rules: list[Rule]) -> Column:
    """The list as one conditional expression: the number of the first rule
    that holds (from 1), or 0."""
    out = None
    for k, rule in enumerate(rules, 1):
        on = rule[0].column()
        for c in rule[1:]:
            on = on & c.column()
        out = F.when(on, k) if out is None else out.when(on, k)
    return F.lit(0) if out is None else out.otherwise(0)


def _first(known: DataFrame, n: int) -> list:
    """The first ``PER_CLASS`` of ``n`` rows by a hash of the id. Tasks send
    what lies below twice the share needed, not ``PER_CLASS`` rows each."""
    order, want = F.xxhash64("doc_id"), min(PER_CLASS, n)
    below = min((1 << 63) - 1, -(1 << 63) + (2 * PER_CLASS << 64) // n)
    rows = known.where(order <= below).orderBy(order, "doc_id").limit(want).collect()
    return rows if len(rows) == want else known.orderBy(order, "doc_id").limit(want).collect()


def fit_rules(counts: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> list[Rule]:
    """Learns the list from the rows of ``counts`` that are labelled, not held
    out, and pass the base rule."""
    one = (labels.select(F.col(id_col).alias("labelled_id"), F.col(label_col).cast("int").alias("label"))
           .where(F.col("label").isin(0, 1) & F.col("labelled_id").isNotNull() & ~held_out("labelled_id"))
           .groupBy("labelled_id").agg((F.avg("label") >= 0.5).cast("int").alias("label")))
    stats = statistics()
    known = (counts.where(~base_failed()).groupBy("doc_id").agg(F.min(F.struct(*COUNTS)).alias("of"))
             .join(one, F.col("doc_id") == F.col("labelled_id")).select("doc_id", "label", "of.*")
             .select("doc_id", "label", *[c.alias(n) for n, c in stats.items()]))
    known = saved(known, "rules-labelled")
    n = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        return []
    rows = _first(known.where("label = 0"), n[0]) + _first(known.where("label = 1"), n[1])
    x = np.array([[r[s] for s in stats] for r in rows], float)
    y = np.array([r.label for r in rows])
    return learn_rules(x, y == 0, class_weights(y, (n[0], n[1])), list(stats))


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, the ``COUNTS``, base_failed, kept, rule
    (the text of the first rule that holds, or null)."""
    counts = saved(text_counts(docs, id_col, text_col), "rules-counts")
    rules = fit_rules(counts, labels, id_col)
    stats = counts.select("*", *[c.alias(n) for n, c in statistics().items()])
    out = stats.select("doc_id", *COUNTS, base_failed().alias("base_failed"), first_rule(rules).alias("k"))
    texts = F.array(*[F.lit(" and ".join(map(str, r))) for r in rules]).cast("array<string>")
    return out.select("doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & (F.col("k") == 0)).alias("kept"),
                      F.get(texts, F.col("k") - 1).alias("rule"))
