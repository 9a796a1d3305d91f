"""LM scoring by cross-entropy difference.

A target model (documents labelled of good quality, not held out) and a
background model (all documents) are word bigram models over one
vocabulary. A document's score is its loss per token under the target model
minus that under the background model: the lower, the closer to the target.

The vocabulary is every word that stands at least ``LEAST`` times, all others
being one unknown word; a model keeps every bigram with a count of ``LEAST``
or more and backs off to single words for the rest by absolute discounting.
That floor is the same at every corpus size, so what is counted grows with the
corpus. The models are matched: same vocabulary, order, discount and, by
scaling the background's counts to the target's tokens, same size; a discount
takes no more than half of a scaled count, so scaling loses no bigram. Counts
cover all documents.

The corpus is cut into chunks of about ``CHUNK_TOKENS`` tokens, written once
as numbers. The models are never in one place: each of the three questions
that scoring asks (how often does a word stand, how often a bigram, how much
do a word's kept bigrams take) is put by every chunk about its own words or
bigrams, in sorted pieces, one for each range of hashes (a bucket). A bucket
adds up what all chunks sent and answers each piece in its order; the chunk
puts the answers together. So a row of a shuffle is a piece, not a bigram; a
chunk or a bucket is what a task holds (buckets are as many as the text is
large), and a word that stands in every text is one number in each piece.
Words and bigrams go by 64-bit hashes.

Defined cases: a null or empty text has no tokens and score 0; without
target documents the target equals the background (all scores 0); repeated
rows count and score each; labels of one document are taken by majority; an
empty table gives no rows; columns other than id and text are never read. A
text is never cut: one beyond ``CHUNK_TOKENS`` is a chunk by itself.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, saved, ship, slices, text_of

#: Occurrences from which a word, or a model's bigram, is kept.
LEAST = 2
DISCOUNT = 0.5
#: Tokens of a chunk, about, and different words whose hashes a task remembers.
CHUNK_TOKENS = 1 << 20
WORDS_AT_ONCE = 300_000
#: Tokens of the corpus for which there is one bucket.
BUCKET_TOKENS = 3 << 20
#: Labelled ids up to which they are broadcast (32 MB); more are joined by a shuffle.
BROADCAST_IDS = 4_000_000

UNKNOWN, START, FIRST_WORD = 0, 1, 2
_WORD = re.compile(r"\w+")
_TURN = np.uint64(23)                       # bits that a previous word's hash is turned by


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class _Hashes(dict):
    """64-bit hashes of words; the first two numbers are not given out."""

    def __missing__(self, word: str) -> int:
        h = self[word] = max(xxhash.xxh64_intdigest(word.encode("utf-8", "replace")), FIRST_WORD)
        return h

    def of(self, text: str) -> np.ndarray:
        if len(self) > WORDS_AT_ONCE:
            self.clear()
        words = words_of(text)
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


# ------------------------------------------------------------ arrays as bytes

def _pack(x: np.ndarray) -> bytes:
    """Length and compressed bytes of an array."""
    raw = np.ascontiguousarray(x).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(b: bytes, kind) -> np.ndarray:
    return np.frombuffer(pa.decompress(b[8:], int.from_bytes(b[:8], "little"), codec="zstd", asbytes=True), kind)


def _pack_rising(x: np.ndarray) -> bytes:
    """Rising hashes, by their differences: the first bytes of all, then the
    second ones and so on, since the high ones are alike."""
    steps = np.diff(x, prepend=np.uint64(0)).astype("<u8")
    return _pack(steps.view(np.uint8).reshape(-1, 8).T)


def _unpack_rising(b: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(_unpack(b, np.uint8).reshape(8, -1).T).view("<u8").reshape(-1)
    return np.cumsum(steps, dtype=np.uint64)


# ------------------------------------------------------------ questions and answers

#: What is asked: how often words stand, how often bigrams, what their kept bigrams take of words.
WORDS, PAIRS, TAKEN = range(3)
_VALUES = "a binary, b binary, c binary, d binary"
_ASKED = f"bucket int, chunk bigint, ids binary, {_VALUES}"
_TOTALS = ("words", "all_b", "all_t", "rare_b", "rare_t")
_ANSWERED = f"chunk bigint, kind int, bucket int, {_VALUES}, {', '.join(f'{c} bigint' for c in _TOTALS)}"
_ARROW = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}


def _table(rows: list[tuple], schema: str) -> pa.Table:
    fields = [f.split() for f in schema.split(", ")]
    return pa.Table.from_arrays([pa.array([r[j] for r in rows], _ARROW[t]) for j, (_, t) in enumerate(fields)], [n for n, _ in fields])


def _asks(chunk: int, buckets: int, ids: np.ndarray, values: list[np.ndarray]) -> list[tuple]:
    """A chunk's pieces: rising ``ids`` by bucket, with their values."""
    width = -(-(1 << 64) // buckets)
    edges = [0, *np.searchsorted(ids, np.array([k * width for k in range(1, buckets)], np.uint64)).tolist(), len(ids)]
    return [(k, chunk, _pack_rising(ids[lo:hi]), *[_pack(v[lo:hi]) for v in values], *[None] * (4 - len(values)))
            for k, (lo, hi) in enumerate(zip(edges, edges[1:])) if hi > lo]


def _answered(asks: DataFrame, kind: int, name: str) -> DataFrame:
    """Sums of what all chunks sent about each id, to each that asked."""
    dtype = np.float64 if kind == TAKEN else np.int64

    def answer(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        pieces = [_unpack_rising(x) for x in table.column("ids").to_pylist()]
        ids, first, at = np.unique(np.concatenate(pieces), return_index=True, return_inverse=True)
        sums = []
        for c in "abcd":
            parts = [x for x in table.column(c).to_pylist() if x is not None]
            if parts:
                weights = np.concatenate([_unpack(x, dtype) for x in parts])
                sums.append(np.bincount(at, weights=weights, minlength=len(ids)).astype(dtype))
        totals = [None] * len(_TOTALS)
        if kind == WORDS:
            b, t = sums
            rare = b < LEAST
            totals = [int(x) for x in ((~rare).sum(), b.sum(), t.sum(), b[rare].sum(), t[rare].sum())]
        if kind == PAIRS:                     # only kept ones are told; the first chunk that asked owns a bigram
            sums = [np.where(sums[0] >= LEAST, x, 0) for x in sums]
        got = [x[at] for x in sums]
        if kind == PAIRS:
            own = np.zeros(len(at), np.int64)
            own[first] = 1
            got.append(own)
        bucket, rows, lo = table.column("bucket")[0].as_py(), [], 0
        for chunk, piece in zip(table.column("chunk").to_pylist(), pieces):
            part = slice(lo, lo + len(piece))
            lo += len(piece)
            rows.append((chunk, kind, bucket, *[_pack(x[part]) for x in got], *[None] * (4 - len(got)), *totals))
            totals = [None] * len(_TOTALS)    # once a bucket
        return _table(rows, _ANSWERED)

    return saved(asks.groupBy("bucket").applyInArrow(answer, _ANSWERED), name, clean=True)


# ------------------------------------------------------------ chunks

def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts (doc_id, target, text) -> chunks: their ids, whether they are
    targets, their sizes, the chunk's rising word hashes, and its tokens as
    places among those."""
    hashes, n_chunks = _Hashes(), 0
    ids: list = []
    targets: list[bool] = []
    texts: list[np.ndarray] = []
    kind = None

    def chunk() -> pa.RecordBatch:
        words, tokens = np.unique(np.concatenate(texts), return_inverse=True)
        sizes, target = np.array([len(x) for x in texts], np.int64), np.array(targets, bool)
        begun = sizes > 0
        name = TaskContext.get().partitionId() << 32 | n_chunks
        return pa.RecordBatch.from_arrays(
            [pa.array([name], pa.int64()), pa.array([ids], pa.list_(kind)), pa.array([target.tobytes()], pa.binary()),
             pa.array([_pack(sizes)], pa.binary()), pa.array([_pack_rising(words)], pa.binary()),
             pa.array([_pack(tokens.astype(np.int32))], pa.binary()), pa.array([int(sizes.sum())], pa.int64()),
             pa.array([int(begun.sum())], pa.int64()), pa.array([int((begun & target).sum())], pa.int64())],
            ["chunk", "ids", "target", "sizes", "words", "tokens", "n", "starts_b", "starts_t"])

    held = 0
    for batch in (part for whole in batches for part in slices(whole)):
        kind = batch.schema.field(0).type
        for i, target, text in zip(*[batch.column(k).to_pylist() for k in range(3)]):
            x = hashes.of(text)
            if held and held + len(x) > CHUNK_TOKENS:
                yield chunk()
                ids, targets, texts, held, n_chunks = [], [], [], 0, n_chunks + 1
            ids.append(i)
            targets.append(target)
            texts.append(x)
            held += len(x)
    if texts:
        yield chunk()


@dataclass(frozen=True)
class Model:
    """One model's totals over the corpus."""
    tokens: int
    starts: int
    rare: int
    scale: float
    size: int                 # words of the vocabulary, the unknown one and START included

    def kept(self, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(scaled counts, what they leave after the discount) of bigrams that stand n times."""
        c = np.where(n >= LEAST, n * self.scale, 0.0)
        return c, c - np.minimum(DISCOUNT, c / 2)

    def chance(self, n: np.ndarray) -> np.ndarray:
        """Chances of words that stand n times."""
        return (n * self.scale + 1) / ((self.tokens + self.starts) * self.scale + self.size)


class _Chunk:
    """A chunk with the answers it has so far."""

    def __init__(self, chunk: pa.Table, answers: pa.Table):
        row = {c: chunk.column(c)[0].as_py() for c in chunk.column_names}
        self.name, self.ids = row["chunk"], row["ids"]
        self.target = np.frombuffer(row["target"], bool)
        self.sizes, self.words = _unpack(row["sizes"], np.int64), _unpack_rising(row["words"])
        self.tokens = _unpack(row["tokens"], np.int32)
        self.answers: dict[int, list[dict]] = {}
        for r in sorted(answers.to_pylist(), key=lambda r: r["bucket"]) if answers.num_rows else []:
            self.answers.setdefault(r["kind"], []).append(r)

    def answer(self, kind: int, columns: str) -> list[np.ndarray]:
        dtype = np.float64 if kind == TAKEN else np.int64
        rows = self.answers.get(kind, [])
        return [np.concatenate([_unpack(r[c], dtype) for r in rows]) if rows else np.zeros(0, dtype) for c in columns]

    def target_tokens(self) -> np.ndarray:
        return np.repeat(self.target, self.sizes).astype(np.int64)

    def ask_words(self, buckets: int) -> list[tuple]:
        n = np.bincount(self.tokens, minlength=len(self.words))
        t = np.bincount(self.tokens, weights=self.target_tokens(), minlength=len(self.words)).astype(np.int64)
        return _asks(self.name, buckets, self.words, [n, t])

    def with_bigrams(self) -> "_Chunk":
        """Numbers the chunk's words (unknown ones as one, after the others; START
        after that) and its bigrams, by hash."""
        self.word_b, self.word_t = self.answer(WORDS, "ab")
        k = len(self.words)
        self.known = self.word_b >= LEAST
        number = np.where(self.known, np.arange(k), k)
        self.hash = np.concatenate((self.words, np.array([UNKNOWN, START], np.uint64)))
        w = number[self.tokens]
        p = np.empty_like(w)
        p[1:] = w[:-1]
        self.begins = np.cumsum(self.sizes) - self.sizes
        p[self.begins[self.sizes > 0]] = k + 1
        pairs, at, n = np.unique(p * np.int64(k + 2) + w, return_inverse=True, return_counts=True)
        t = np.bincount(at, weights=self.target_tokens(), minlength=len(pairs)).astype(np.int64)
        self.p, self.w = pairs // (k + 2), pairs % (k + 2)
        before = self.hash[self.p]
        code = (before << _TURN | before >> (np.uint64(64) - _TURN)) ^ self.hash[self.w]
        order = np.argsort(code)
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        self.at = place[at]
        self.p, self.w, self.code, self.n, self.t = self.p[order], self.w[order], code[order], n[order], t[order]
        return self

    def ask_pairs(self, buckets: int) -> list[tuple]:
        return _asks(self.name, buckets, self.code, [self.n, self.t])

    def ask_taken(self, buckets: int, models: list[Model], alone: bool) -> list[tuple]:
        b, t, own = self.answer(PAIRS, "abc")
        sums = []
        for model, n in zip(models, (b, b if alone else t)):
            for x in model.kept(np.where(own == 1, n, 0)):
                sums.append(np.bincount(self.p, weights=x, minlength=len(self.hash)))
        used = self._used()
        return _asks(self.name, buckets, self.hash[used], [x[used] for x in sums])

    def _used(self) -> np.ndarray:
        """Words that stand before others, by hash: unknown, START, the known ones."""
        k = len(self.words)
        return np.concatenate(([k, k + 1], np.flatnonzero(self.known)))

    def losses(self, models: list[Model], alone: bool) -> tuple[np.ndarray, list[np.ndarray]]:
        """(tokens, loss per token by model) of every text."""
        pair_n = self.answer(PAIRS, "ab")
        taken = self.answer(TAKEN, "abcd")
        used, out = self._used(), []
        for j, model in enumerate(models):
            k = 0 if alone else j
            n = np.concatenate(((self.word_b, self.word_t)[k], [model.rare, model.starts])).astype(float)
            total, left = np.zeros(len(self.hash)), np.zeros(len(self.hash))
            total[used], left[used] = taken[2 * j], taken[2 * j + 1]
            begun = np.maximum(np.maximum(n * model.scale, 1e-9), total)
            back = np.clip(1 - left / begun, 1e-6, 1.0)
            chance = model.kept(pair_n[k])[1] / begun[self.p] + back[self.p] * model.chance(n)[self.w]
            loss = -np.log(chance)[self.at]
            sums = np.zeros(len(self.sizes))
            some = self.sizes > 0
            if some.any():
                sums[some] = np.add.reduceat(loss, self.begins[some])
            out.append(sums / np.maximum(self.sizes, 1))
        return self.sizes, out


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "quality") -> DataFrame:
    """One row per document: doc_id, n_tokens, target_loss, background_loss, score."""
    ship(docs.sparkSession)
    good = saved(labels.select(F.col(id_col).alias("good_id"), F.col(label_col).cast("int").alias("label"))
                 .where(F.col("good_id").isNotNull() & ~held_out("good_id"))
                 .groupBy("good_id").agg(F.avg("label").alias("label")).where("label >= 0.5").select("good_id"), "lm-target")
    chosen = F.broadcast(good) if good.count() <= BROADCAST_IDS else good
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    marked = rows.join(chosen, F.col("doc_id") == F.col("good_id"), "left").select("doc_id", F.col("good_id").isNotNull().alias("target"), "text")
    chunks = saved(marked.mapInArrow(_chunks, f"chunk bigint, ids array<{kind}>, target binary, sizes binary, words binary, "
                                     "tokens binary, n bigint, starts_b bigint, starts_t bigint"), "lm-chunks", clean=True)
    size = chunks.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "starts_b", "starts_t")]).first()
    buckets = max(1, -(-size.n // BUCKET_TOKENS))

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = pa.table({"kind": pa.array([], pa.int32())})
        for batch in batches:
            for i in range(len(batch)):
                yield from _table(_Chunk(pa.Table.from_batches([batch.slice(i, 1)]), none).ask_words(buckets), _ASKED).to_batches()

    def with_answers(answers: DataFrame, ask: Callable[[_Chunk], pa.Table], schema: str) -> DataFrame:
        told = answers.select("chunk", "kind", "bucket", *"abcd")
        return chunks.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(
            lambda chunk, answer: ask(_Chunk(chunk, answer).with_bigrams()), schema)

    answers = _answered(chunks.mapInArrow(asked, _ASKED), WORDS, "lm-words")
    totals = answers.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _TOTALS]).first()
    alone = totals.all_t == 0                     # no target documents: the target is the background
    target = totals.all_b if alone else totals.all_t
    models = [Model(totals[f"all_{m}"], size[f"starts_{m}"], totals[f"rare_{m}"], target / max(totals[f"all_{m}"], 1),
                    totals.words + FIRST_WORD) for m in ("bb" if alone else "bt")]
    pairs = with_answers(answers, lambda c: _table(c.ask_pairs(buckets), _ASKED), _ASKED)
    answers = answers.unionByName(_answered(pairs, PAIRS, "lm-pairs"))
    taken = with_answers(answers, lambda c: _table(c.ask_taken(buckets, models, alone), _ASKED), _ASKED)
    answers = answers.unionByName(_answered(taken, TAKEN, "lm-taken"))
    id_type = chunks.schema["ids"].dataType.elementType

    def scored(c: _Chunk) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_type
        n, (background, target) = c.losses(models, alone)
        return pa.Table.from_arrays([pa.array(c.ids, to_arrow_type(id_type)), pa.array(n, pa.int64()), pa.array(target, pa.float64()),
                                     pa.array(background, pa.float64())], ["doc_id", "n_tokens", "target_loss", "background_loss"])

    out = with_answers(answers, scored, f"doc_id {kind}, n_tokens bigint, target_loss double, background_loss double")
    return saved(out, "lm-scores", clean=True).withColumn("score", F.col("target_loss") - F.col("background_loss"))
