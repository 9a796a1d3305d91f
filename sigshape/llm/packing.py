"""Packing: token sequences of one length, filled by non-negative least squares.

A document's ids are cut into full windows and one remainder. Remainders are
packed by their length histogram (at most ``window`` numbers, whatever the
corpus): combinations of up to three length classes that fill a window
exactly are enumerated, non-negative least squares solves how often each is
repeated, the counts are rounded down, and what is left is packed greedily
(longest first, then the longest that still fits). The solver sees the
histogram only; the pieces never leave the executors: a piece's rank among
the pieces of its length selects its place in the plan by one join with the
plan's intervals.

Defined cases: a null text is empty; an empty text is its end id alone; the
special tokens' strings in a text are ordinary text; a very long text gives
many full windows; repeated rows are packed once each; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CELL_ROWS, gapless_rank, saved, ship, slices, text_of

WINDOW = 2048
END_ID = 1
#: Lengths are solved for in classes of so many tokens.
CLASS_TOKENS = 8
#: A Python worker remembers the ids of up to twice as many words.
WORD_CACHE = 250_000

_PIECES = "doc_id {id}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def _bytes(ids: list[int]) -> bytes:
    """Ids as little-endian 32-bit numbers."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


#: Bytes as the byte-level step writes them: printable ones (in Latin-1) as they are, the others in order from U+0100 on.
_SHOWN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_LEVEL = {b: 0x100 + k for k, b in enumerate(b for b in range(0x100) if b not in _SHOWN)}


def _folded(word: str) -> str | None:
    """A word of Latin letters (up to U+024F, all composed) as the tokenizer's
    model gets it, in lower case and byte by byte; None: not such a word."""
    if not word.isalpha():
        return None
    low = word.lower()
    if word.isascii():
        return low
    if max(word) > "\u024f" or not low.isalpha():
        return None
    return low.encode().decode("latin-1").translate(_BYTE_LEVEL)


class WordTokenizer:
    """Ids of a text, word by word.

    The tokenizer never joins characters across a space or line end (other
    white space stays inside a "word" here), nor a letter and a comma or full stop after it, so words may be tokenized alone and
    remembered. ASCII words are looked up in lower case, as the tokenizer
    folds them.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")      # a task is one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _learn(self, words: set[str]) -> None:
        """Makes ``words`` known; half of the memory is dropped when it is full,
        words used since the last time stay."""
        if len(self.known) > WORD_CACHE:
            self.older, self.known = self.known, {}
        words = words.difference(self.known)
        new = words.difference(self.older)
        for w in words.difference(new):
            self.known[w] = self.older[w]
        new = list(new)
        stems = [w[:-1] if len(w) > 1 and w[-1] in ",." and w[-2].lower()[-1].isalpha() else w for w in new]
        fresh = {s for s in stems if s not in self.known} | {",", "."}
        # A word of Latin letters is one pre-token: the model takes it as it is folded.
        other, tokenize = [], self.tokenizer.model.tokenize
        for s in fresh:
            folded = _folded(s)
            if folded is None:
                other.append(s)
            else:
                self.known[s] = _bytes([t.id for t in tokenize(folded)])
        for s, e in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False)):
            self.known[s] = _bytes(e.ids)
        for w, s in zip(new, stems):
            if w != s:
                self.known[w] = self.known[s] + self.known[w[-1]]

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text; new words are tokenized in one call."""
        split = [(t.lower() if t.isascii() else t).replace("\n", " ").split(" ") for t in texts]
        self._learn(set().union(*split))
        get = self.known.__getitem__
        for words in split:
            yield b"".join(map(get, words))


_loaded: dict[str, WordTokenizer] = {}


def tokenizer_at(path: str) -> WordTokenizer:
    """One tokenizer for each Python worker (its word memory stays between batches)."""
    if path not in _loaded:
        _loaded[path] = WordTokenizer(path)
    return _loaded[path]


def _cut(tokenizer_path: str, window: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_at(tokenizer_path)
        end = np.array([END_ID], "<u4").tobytes()
        step = 4 * window
        for batch in (part for whole in batches for part in slices(whole)):
            of, start, length, crc, total = [], [], [], [], []
            for i, ids in enumerate(tokenizer.ids(batch.column(1).to_pylist())):
                ids += end
                n = len(ids) // 4
                for at in range(0, n, window):
                    of.append(i)
                    start.append(at)
                    length.append(min(window, n - at))
                    crc.append(zlib.crc32(ids[4 * at:4 * at + step]))
                    total.append(n)
            columns = [batch.column(0).take(pa.array(of, pa.int64())),
                       *(pa.array(x, pa.int64()) for x in (start, length, crc, total))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
    return cut


# ------------------------------------------------------------------ the plan, from the histogram

def nnls(columns: np.ndarray, b: np.ndarray, weight: np.ndarray, tol: float = 1e-7) -> np.ndarray:
    """Non-negative least squares by active sets: min ||W (A x - b)||, x >= 0.

    Column j of A is the sum of the unit vectors ``columns[j]``; index 0 means
    none and has weight 0. The active columns' Gram matrix grows by one row a step.
    """
    target = weight * b
    x, on = np.zeros(len(columns)), []
    part, gram = np.zeros((len(b), 0)), np.zeros((0, 0))
    scale = max(1.0, float(np.abs(target).max(initial=0)))
    for _ in range(4 * len(b)):
        grad = (weight * (target - part @ x[on]))[columns].sum(axis=1)
        grad[on] = -np.inf
        j = int(np.argmax(grad)) if len(columns) else 0
        if not len(columns) or grad[j] <= tol * scale:
            break
        new = np.zeros(len(b))
        np.add.at(new, columns[j], weight[columns[j]])
        side = part.T @ new
        gram = np.block([[gram, side[:, None]], [side[None, :], np.array([[new @ new]])]])
        part = np.hstack([part, new[:, None]])
        on.append(j)
        while True:
            s = np.linalg.solve(gram + 1e-9 * np.eye(len(on)), part.T @ target)
            neg = s <= 0
            if not neg.any():
                x[on] = s
                break
            now = x[on]
            step = np.min(now[neg] / np.maximum(now[neg] - s[neg], 1e-300))
            now = now + step * (s - now)
            keep = now > 1e-12
            x[on] = np.where(keep, now, 0.0)
            on = [c for c, k in zip(on, keep) if k]
            part, gram = part[:, keep], gram[np.ix_(keep, keep)]
    return x


def combinations(classes: int, present: np.ndarray) -> np.ndarray:
    """Up to three length classes (multiples of the class width, 0: none) that
    fill a window, each class being present; largest first."""
    a, b = np.meshgrid(np.arange(classes + 1), np.arange(classes + 1), indexing="ij")
    c = classes - a - b
    ok = (a >= b) & (b >= c) & (c >= 0)
    out = np.stack([a[ok], b[ok], c[ok]], axis=1)
    has = present.copy()
    has[0] = True
    return out[has[out].all(axis=1)]


def _take(stock: np.ndarray, cls: int, width: int, n: int) -> list[list[int]]:
    """Takes ``n`` pieces of a class from the stock: [length, count] runs, longest first."""
    runs = []
    for length in range(cls * width, (cls - 1) * width, -1):
        k = int(min(n, stock[length]))
        if k:
            stock[length] -= k
            runs.append([length, k])
            n -= k
    return runs


def plan(histogram: dict[int, int], window: int = WINDOW, width: int = CLASS_TOKENS) -> list[tuple]:
    """Patterns ({length: pieces}, repeats) that use up the histogram.

    Every pattern's lengths sum to at most ``window``. Whole windows are a
    pattern of their own.
    """
    stock = np.zeros(window + 1, np.int64)
    for length, n in histogram.items():
        stock[length] = n
    patterns: list[tuple[dict[int, int], int]] = []
    if stock[window]:
        patterns.append(({window: 1}, int(stock[window])))
        stock[window] = 0
    classes = window // width
    by_class = np.zeros(classes + 1, np.int64)
    np.add.at(by_class, -(-np.arange(window + 1) // width), stock)
    combos = combinations(classes, by_class > 0)
    if len(combos):
        # Long pieces weigh more: what is left over then is short and packs well.
        weight = np.arange(classes + 1) / classes
        repeats = np.floor(nnls(combos, by_class.astype(float), weight) + 1e-6).astype(np.int64)
        for j in np.flatnonzero(repeats):
            combo = [int(c) for c in combos[j] if c]
            have = [int(sum(stock[(c - 1) * width + 1:c * width + 1])) for c in combo]
            n = int(min([repeats[j], *(h // combo.count(c) for h, c in zip(have, combo))]))
            slots = [_take(stock, c, width, n) for c in combo]
            while n:                                  # runs of equal lengths in every slot
                k = min(s[0][1] for s in slots)
                used: dict[int, int] = {}
                for s in slots:
                    used[s[0][0]] = used.get(s[0][0], 0) + 1
                    s[0][1] -= k
                    if not s[0][1]:
                        s.pop(0)
                patterns.append((used, k))
                n -= k
    return patterns + greedy(stock, window)


def greedy(stock: np.ndarray, window: int) -> list[tuple]:
    """What is left: the longest piece, then ever the longest that still fits;
    a pattern is repeated as long as its lengths last."""
    patterns = []
    stock = stock.copy()
    while True:
        left = np.flatnonzero(stock)
        if not len(left):
            return patterns
        used: dict[int, int] = {}
        room = window
        while True:
            fits = left[:np.searchsorted(left, room, side="right")]
            if not len(fits):
                break
            length = int(fits[-1])
            k = int(min(room // length, stock[length]))
            used[length] = k
            room -= k * length
            left = fits[:-1]
        n = int(min(stock[length] // k for length, k in used.items()))
        for length, k in used.items():
            stock[length] -= n * k
        patterns.append((used, n))


def intervals(patterns: list[tuple]) -> pd.DataFrame:
    """Rank intervals: pieces of ``length`` with rank in [lo, hi) go, ``k`` to
    a sequence, to sequences from ``sequence`` on, at ``offset`` and on."""
    taken: dict[int, int] = {}
    out, sequence = [], 0
    for used, n in patterns:
        offset = 0
        for length, k in used.items():
            lo = taken.get(length, 0)
            taken[length] = lo + n * k
            out.append((length, lo, lo + n * k, k, sequence, offset))
            offset += k * length
        sequence += n
    return pd.DataFrame(out, columns=["at_length", "lo", "hi", "k", "first_sequence", "first_offset"], dtype="int64")


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    schema = _PIECES.format(id=rows.schema["doc_id"].dataType.simpleString())
    # ``copy`` tells repeated rows apart, so that they do not all fall into one cell.
    pieces = saved(rows.mapInArrow(_cut(tokenizer_path, window), schema).withColumn("copy", F.monotonically_increasing_id()), "pack-pieces")
    counted = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n"))          # at most `window` rows
    histogram = {r.length: r.n for r in counted.collect()}
    places = intervals(plan(histogram, window))
    if not histogram:
        return pieces.drop("copy").select("*", F.lit(0).cast("bigint").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    cells = spark.createDataFrame([(k, -(-n // CELL_ROWS)) for k, n in histogram.items()],
                                  "of_length bigint, cells bigint")
    dealt = pieces.join(F.broadcast(cells), pieces["length"] == cells["of_length"])
    ranked = gapless_rank(dealt, "length", F.col("cells"), salt=["doc_id", "start", "ids_crc32", "copy"],
                          order=["doc_id", "start", "ids_crc32", "copy"])
    steps = F.broadcast(spark.createDataFrame(places))           # bounded by the histogram's lengths
    here = (F.col("length") == F.col("at_length")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
    nth = F.col("rank") - F.col("lo")
    return (ranked.join(steps, here)
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                    (F.col("first_sequence") + F.floor(nth / F.col("k"))).cast("bigint").alias("sequence_id"),
                    (F.col("first_offset") + nth % F.col("k") * F.col("length")).alias("offset")))
