"""SimHash near-dedup with covering locality-sensitive hashing.

A fingerprint has 64 bits; bit b is set if it is set in over half of the
XXH64 values (seed 42) of the text's word shingles, repeats included. Texts
link when their fingerprints differ in at most ``radius`` bits, and the
result is the connected components of these links.

Candidates: every bit gets a fixed non-zero vector of ``radius + 1`` bits, and
table v (v = 1 .. 2^(radius+1) - 1) looks only at the bits whose vector has
an odd overlap with v. Any ``radius`` bits have a table that looks at none
of them, so every pair within the radius agrees in some table: no link can
be missed. Each table looks at about half of the bits.

Equal fingerprints collapse first (a group of copies is one row). A bucket of
a table is compared inside one task without emitting its pairs: a bucket of n
fingerprints gives at most n - 1 links, a spanning forest of all links in it.
A bucket larger than ``BLOCK`` is cut into blocks, and every pair of blocks is
compared as a bucket of its own, so no task holds a whole hot bucket.

Defined cases: a null or empty text, or one of white space alone, has
fingerprint zero, linked like any other; a text of fewer words than a
shingle is one shingle; a null id is larger than all others; repeated rows
give repeated rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, ship, slices, text_of
from .components import components
from .decisions import drop_rows, text_key

SHINGLE = 4
RADIUS = 4
SEED = 42
#: Fingerprints of one bucket that a task compares at once.
BLOCK = 2048
_COUNT_AT_ONCE = 1 << 14


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint, unsigned. Bytes are lower-cased and split as
    ASCII, so only A-Z and the six ASCII blanks are touched."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    last = ends[min(shingle, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_digest
    over = np.zeros(64, np.int64)
    for i in range(0, len(last), _COUNT_AT_ONCE):
        raw = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[i:i + _COUNT_AT_ONCE], last[i:i + _COUNT_AT_ONCE])])
        over += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = over * 2 > len(last)
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def with_fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(doc_id, key, fp) of every row; fp as a signed bigint."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_key(text_col).alias("key"), text_of(text_col).alias("text"))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            fps = [_signed(fingerprint(t, shingle)) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps, pa.int64())], ["doc_id", "key", "fp"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(compute, f"doc_id {kind}, key bigint, fp bigint")


def covering_masks(radius: int = RADIUS, bits: int = 64) -> list[int]:
    """One mask for each table. Vectors run through 1 .. 2^(radius+1) - 1 in
    turn, so every table looks at about as many bits."""
    top = 1 << (radius + 1)
    vector = [1 + (b * 11) % (top - 1) for b in range(bits)]
    return [sum(1 << b for b in range(bits) if (vector[b] & v).bit_count() % 2) for v in range(1, top)]


def forest(fps: np.ndarray, radius: int, rows: int) -> tuple[list[int], list[int]]:
    """A spanning forest of the links among ``fps`` (unsigned, distinct):
    those within ``radius`` bits. The first ``rows`` are compared with all."""
    label = np.arange(len(fps))
    one, other = [], []
    for i in range(min(rows, len(fps) - 1)):
        near = i + 1 + np.flatnonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= radius)
        near = near[label[near] != label[i]]
        if len(near):
            new, first = np.unique(label[near], return_index=True)
            one += [i] * len(new)
            other += near[first].tolist()
            label[np.isin(label, new)] = label[i]
    return one, other


def _linked(radius: int):
    """Rows (cell, side, fp) sorted by cell and side -> links of every cell."""
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(0, np.int64)
        sides = np.zeros(0, np.int8)
        fps = np.zeros(0, np.int64)

        def of(start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
            two = start[end - start == 2]                 # most buckets: one pair each
            two = two[np.bitwise_count((fps[two] ^ fps[two + 1]).view(np.uint64)) <= radius]
            left, right = fps[two].tolist(), fps[two + 1].tolist()
            more = end - start > 2
            for a, b in zip(start[more].tolist(), end[more].tolist()):
                part = fps[a:b]
                n_left = int((sides[a:b] == 0).sum())
                x, y = forest(part.view(np.uint64), radius, n_left)
                left += part[x].tolist()
                right += part[y].tolist()
            return pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["u", "v"])

        for batch in batches:
            cells = np.concatenate((cells, batch.column(0).to_numpy(zero_copy_only=False)))
            sides = np.concatenate((sides, batch.column(1).to_numpy(zero_copy_only=False)))
            fps = np.concatenate((fps, batch.column(2).to_numpy(zero_copy_only=False)))
            edges = np.flatnonzero(cells[1:] != cells[:-1]) + 1
            if len(edges):                              # the last cell may go on in the next batch
                start = np.concatenate(([0], edges[:-1]))
                yield of(start, edges)
                k = edges[-1]
                cells, sides, fps = cells[k:], sides[k:], fps[k:]
        if len(cells):
            yield of(np.array([0]), np.array([len(cells)]))
    return links


def links(fps: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Links (u, v) among distinct fingerprints ``fp``: a spanning forest of
    every bucket, whose union connects exactly what lies within the radius."""
    masks = F.array(*[F.lit(_signed(m)) for m in covering_masks(radius)])
    keyed = fps.select("fp", F.posexplode(masks).alias("t", "mask"))
    keyed = keyed.select("fp", F.xxhash64("t", F.col("fp").bitwiseAND(F.col("mask"))).alias("key"))
    # A bucket's number of blocks; buckets of one fingerprint go.
    sizes = (keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
             .select(F.col("key").alias("k"), F.ceil(F.col("n") / block).cast("bigint").alias("blocks")))
    # Neither side may be broadcast: Spark counts an exploded table as large as
    # the one before, a thirty-first of it, and both sides have up to 31 rows a fingerprint.
    found = (keyed.join(sizes.hint("merge"), F.col("key") == F.col("k"))
             .withColumn("b", F.pmod(F.xxhash64("fp"), "blocks")))
    # Cell (i, j), i <= j, holds block i against itself and block j: fp is on the
    # left of the cells (b, j) and on the right of the cells (i, b).
    cell = (F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("o"))
    found = found.select("fp", "key", "b", cell).select(
        F.xxhash64("key", F.least("b", "o"), F.greatest("b", "o")).alias("cell"),
        (F.col("b") > F.col("o")).cast("tinyint").alias("side"), "fp")
    return (found.repartition("cell").sortWithinPartitions("cell", "side")
            .mapInArrow(_linked(radius), "u bigint, v bigint"))


def _components(docs: DataFrame, id_col: str, text_col: str, shingle: int,
                radius: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Every row's fingerprint (doc_id, key, fp), every fingerprint's root, and
    every root's ``least`` document (smallest id, then least text hash)."""
    ship(docs.sparkSession)
    prints = saved(with_fingerprints(docs, id_col, text_col, shingle), "simhash-prints")
    fps = saved(prints.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("first")), "simhash-distinct")
    edges = saved(links(fps.select("fp"), radius), "simhash-links")
    labels = components(edges)
    rooted = (fps.join(labels, F.col("fp") == F.col("node"), "left")
              .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    least = saved(rooted.groupBy("root").agg(F.min("first").alias("least")), "simhash-least")
    return prints, rooted, least


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id."""
    prints, rooted, least = _components(docs, id_col, text_col, shingle, radius)
    of = rooted.join(least, "root").select(F.col("fp").alias("of_fp"), F.col("least.doc_id").alias("component_id"))
    return (prints.join(of, F.col("fp") == F.col("of_fp"))
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one document of each component (its smallest id,
    then the least text hash); all columns stay."""
    prints, _, least = _components(docs, id_col, text_col, shingle, radius)
    pair = F.struct("doc_id", "key")
    kept = least.select(F.struct("least.doc_id", "least.key").alias("of"))
    dropped = prints.select(pair.alias("pair")).distinct().join(kept, F.col("pair") == F.col("of"), "left_anti")
    return drop_rows(docs, dropped.select("pair.doc_id", "pair.key"), id_col, text_col, once=True)
