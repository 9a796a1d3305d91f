"""Turns of conversations in their order, and hashes of long ordered lists."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

#: Items of a list that are joined to one piece of text.
PIECE = 20_000


def turn_digest() -> Column:
    """SHA-256 of a row's role and text; the role's length keeps them apart."""
    return F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256))


def in_order(turns: DataFrame, keep: dict[str, Column], name: str) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) as a written table with ``at``,
    which rises from conversation to conversation and within each by turn
    (null first), then role, then text; plus the columns ``keep``.

    The rows are dealt by ranges of that order, so a conversation that holds a
    third of all rows falls to many tasks. Range bounds see the heads of role
    and text only; the sort within a range sees the whole of them.
    """
    turn = F.col("turn").asc_nulls_first()
    dealt = turns.repartitionByRange(F.col("conv_id").asc_nulls_first(), turn, F.left("role", F.lit(16)), F.left("text", F.lit(48)))
    ordered = dealt.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), turn, "role", "text")
    return saved(ordered.select("conv_id", F.monotonically_increasing_id().alias("at"),
                                *[c.alias(k) for k, c in keep.items()]), name, clean=True)


def joined_pieces(items: DataFrame, key: str, item: str) -> DataFrame:
    """(key, first, piece): a key's items in ascending order, comma-joined in
    pieces of at most ``PIECE``. A key with a third of all items is dealt to
    many tasks, each of which holds one piece."""
    kinds = items.schema[key].dataType.simpleString(), items.schema[item].dataType.simpleString()
    dealt = items.select(key, item).repartitionByRange(key, item).sortWithinPartitions(key, item)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, held = None, []
        out: list[list] = [[], [], []]
        size = 0

        def put() -> None:
            for column, x in zip(out, (of, held[0], ",".join(map(str, held)))):
                column.append(x)

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(out[0], types[0]), pa.array(out[1], types[1]), pa.array(out[2], pa.string())],
                                              ["key", "first", "piece"])

        types: list = []
        for batch in batches:
            types = [batch.schema.field(0).type, batch.schema.field(1).type]
            for k, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if held and (k != of or len(held) >= PIECE):
                    put()
                    size += len(held)
                    held = []
                    if size >= PIECE:
                        yield batch_of()
                        out, size = [[], [], []], 0
                of = k
                held.append(x)
        if held:
            put()
        if out[0]:
            yield batch_of()

    return dealt.mapInArrow(pieces, f"key {kinds[0]}, first {kinds[1]}, piece string")


def hashed_pieces(pieces: DataFrame, separator: str, order: tuple[str, ...] = ("first",)) -> DataFrame:
    """(key, sha256): lowercase SHA-256 of a key's pieces (key, ``order``,
    piece), joined by ``separator``. SHA-256 reads in order, so a key's pieces
    stream through one task, of which it holds one at a time."""
    kind = pieces.schema["key"].dataType.simpleString()
    dealt = pieces.select("key", *order, "piece").repartition("key").sortWithinPartitions("key", *order)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, of, sha, type_ = False, None, None, None
        keys: list = []
        out: list[str] = []
        for batch in batches:
            type_ = batch.schema.field(0).type
            for k, piece in zip(batch.column(0).to_pylist(), batch.column("piece").to_pylist()):
                if not begun or k != of:
                    if begun:
                        keys.append(of)
                        out.append(sha.hexdigest())
                    begun, of, sha = True, k, hashlib.sha256()
                else:
                    sha.update(separator.encode())
                sha.update(piece.encode("utf-8", "replace"))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(keys, type_), pa.array(out, pa.string())], ["key", "sha256"])
                keys, out = [], []
        if begun:
            yield pa.RecordBatch.from_arrays([pa.array([of], type_), pa.array([sha.hexdigest()], pa.string())], ["key", "sha256"])

    return dealt.mapInArrow(hashed, f"key {kind}, sha256 string")
