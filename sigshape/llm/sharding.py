"""Sharding: minimax contiguous partition of ordered atomic groups.

Rows of equal text form one atomic group. Groups are ordered by their
content hash (a fixed random order, so every range of hashes holds its share
of the bytes); the shards are contiguous runs of that order whose largest
size is the smallest possible.

The smallest feasible capacity is binary-searched with the greedy check
("fill a shard until the next group does not fit"). The driver never sees the
groups: it sees segments, i.e. ranges of hashes with their bytes. Taking
whole segments as atoms gives a capacity that is certainly feasible (``hi``);
letting a cut fall anywhere inside a segment gives one that cannot be beaten
(``lo``). Segments in which a cut may fall for a capacity between them are
split by longer hash prefixes, in one job, until ``lo == hi``: the exact
optimum over the groups. At most ``SEGMENTS`` rows come back per job.

Laws: ``bytes`` is the law this method gives. A group larger than an even
share is not split (it is atomic). It sets the capacity, and filling the other
shards up to that would leave some empty; so such groups, fewer than there are
shards, get a shard each, and the same search shares what lies before, between
and after them among the shards left: the largest shard is as small as before,
and so is the largest of the rest.

Defined cases: a null text has no bytes (size 1) and is equal to an empty
text here; a null id is an ordinary id; repeated rows are members of their group; an empty
table gives no rows; fewer groups than shards leave shards empty.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import CELL_ROWS, gapless_rank, saved, text_of

#: Most segments that one job returns to the driver.
SEGMENTS = 1 << 17
#: Hex digits of the hash that the first job groups by (4096 segments).
FIRST_DIGITS = 3
KEY_DIGITS = 32


def greedy_cuts(segments: list[tuple], shards: int, capacity: int, inside: bool) -> list[int] | None:
    """Byte positions of the cuts for ``capacity``, or None if ``shards``
    shards do not hold everything. ``inside``: a cut may fall inside a segment
    of several groups. Between the parts (a segment's last field) there is
    always a cut."""
    cuts, start, at, i = [], 0, 0, 0
    while i < len(segments):
        size, n = segments[i][1], segments[i][3]
        fresh = i > 0 and at > start and segments[i][4] != segments[i - 1][4] and at not in cuts[-1:]
        if not fresh and at + size - start <= capacity:
            at += size
            i += 1
            continue
        cut = start + capacity if inside and n > 1 and not fresh else at
        if cut <= start or len(cuts) == shards - 1:
            return None
        cuts.append(cut)
        start = cut
    return cuts


def smallest(segments: list[tuple], shards: int, low: int, high: int, inside: bool) -> int:
    """The smallest capacity in [low, high] that the greedy check accepts;
    ``high`` is known to be accepted."""
    while low < high:
        mid = (low + high) // 2
        if greedy_cuts(segments, shards, mid, inside) is not None:
            high = mid
        else:
            low = mid + 1
    return low


def open_segments(segments: list[tuple], shards: int, lo: int, hi: int) -> list[int]:
    """Segments of several groups in which a cut can fall for a capacity in [lo, hi].

    The k-th cut of a part lies between the k-th of the whole-segment greedy at
    ``lo`` and k times ``hi`` after its start. Segments larger than ``lo`` are
    split before that.
    """
    too_large = [i for i, s in enumerate(segments) if s[3] > 1 and s[1] > lo]
    if too_large:
        return too_large
    out: list[int] = []
    for part in sorted({s[4] for s in segments}):
        own = [(i, s[1], s[3]) for i, s in enumerate(segments) if s[4] == part]
        first, at, start = [], 0, 0
        for _, size, _ in own:                     # earliest cuts: never past a whole segment
            if at + size - start > lo and at > start and len(first) < shards - 1:
                first.append(at)
                start = at
            at += size
        last = [min(at, (k + 1) * hi) for k in range(len(first))]
        at = 0
        for i, size, n in own:
            if n > 1 and any(at < b and a < at + size for a, b in zip(first, last)):
                out.append(i)
            at += size
    return out


def oversized(largest: list[tuple[str, int]], total: int, shards: int) -> list[str]:
    """Keys of the groups that get a shard each: as long as the largest one
    left is more than an even share of what is left."""
    out = []
    for key, size in sorted(largest, key=lambda x: -x[1]):
        if shards - len(out) < 2 or size * (shards - len(out)) <= total:
            break
        out.append(key)
        total -= size
    return sorted(out)


def minimax_cuts(groups: DataFrame, shards: int, alone: tuple[str, ...] | None = None) -> tuple[int, list[str]]:
    """(capacity, first key prefix of every shard but the first) for
    ``groups`` (key: 32 hex digits, size, n rows). The groups ``alone`` (by
    default the oversized ones) have a shard each."""
    if alone is None:
        total = groups.agg(F.sum("size")).first()[0] or 0
        largest = [(r.key, r.size) for r in groups.orderBy(F.desc("size"), "key").limit(shards).collect()]
        alone = tuple(oversized(largest, total, shards))
        if alone:
            rest, keys = minimax_cuts(groups, shards, alone)
            if 0 <= rest <= largest[0][1]:
                return largest[0][1], keys
            plain, plain_keys = minimax_cuts(groups, shards, ())
            return (rest, keys) if 0 <= rest <= plain else (plain, plain_keys)
    part = F.lit(0)
    for k in alone:
        part = part + (F.col("key") > k).cast("int")
    groups, shards = groups.where(~F.col("key").isin(list(alone))).withColumn("part", part), shards - len(alone)

    def segments_of(df: DataFrame, digits: int) -> list[tuple]:
        rows = (df.groupBy("part", F.substring("key", 1, digits).alias("p"))
                .agg(F.sum("size").alias("size"), F.max("size").alias("most"), F.count(F.lit(1)).alias("n"))
                .collect())
        return [(r.p, r.size, r.most, r.n, r.part) for r in rows]

    order = lambda s: (s[4], s[0])
    segments, digits = sorted(segments_of(groups, FIRST_DIGITS), key=order), FIRST_DIGITS
    if not segments:
        return 0, _first_keys(set(), alone, {})
    parts = {s[4] for s in segments}
    if len(parts) > shards:                   # more gaps between them than shards
        return -1, []
    total = sum(s[1] for s in segments)
    lo = max(math.ceil(total / shards), max(s[2] for s in segments))
    while True:
        hi = smallest(segments, shards, lo, total, inside=False)
        lo = smallest(segments, shards, lo, hi, inside=True)
        todo = open_segments(segments, shards, lo, hi) if lo < hi else []
        if not todo:
            break
        # Longer prefixes for the open segments only: as long as the answer stays small.
        n_groups = sum(segments[i][3] for i in todo)
        step = KEY_DIGITS - digits if n_groups <= SEGMENTS else max(
            1, int(math.log(SEGMENTS / len(todo), 16)))
        digits = min(KEY_DIGITS, digits + step)
        some = {segments[i][0] for i in todo}
        by_len: dict[int, list[str]] = {}
        for p in some:
            by_len.setdefault(len(p), []).append(p)
        inside = F.lit(False)
        for k, ps in by_len.items():
            inside = inside | F.substring("key", 1, k).isin(ps)
        finer = segments_of(groups.where(inside), digits)
        segments = sorted([s for s in segments if s[0] not in some] + finer, key=order)
    cuts, keys, at = set(greedy_cuts(segments, shards, hi, inside=False)), set(), 0
    for before, s in zip([None, *segments], segments):
        if at in cuts and before is not None and before[4] == s[4]:
            keys.add(s[0])
        at += s[1]
    return hi, _first_keys(keys, alone, parts)


def _first_keys(keys: set[str], alone: tuple[str, ...], parts) -> list[str]:
    """First key prefixes of the shards: the cuts inside parts, each group
    that stands alone, and what follows it (its key and more)."""
    for i, k in enumerate(alone):
        if i > 0 or 0 in parts:
            keys.add(k)
        if i + 1 in parts:
            keys.add(k + "0")
    return sorted(keys)


def shard_rows(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = text_of(text_col)
    rows = saved(docs.select(
        F.col(id_col).alias("doc_id"), F.md5(text).alias("key"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.monotonically_increasing_id().alias("copy")), "shard-rows")
    groups = rows.groupBy("key").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
    groups = saved(groups, "shard-groups")
    _, keys = minimax_cuts(groups, shards)
    shard: Column = F.lit(0)
    for k in keys:
        shard = shard + (F.col("key") >= k).cast("int")
    n_rows = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    cells = F.lit(max(16, math.ceil(n_rows / shards / CELL_ROWS)))
    placed = gapless_rank(rows.withColumn("shard", shard), "shard", cells, salt=["doc_id", "key", "copy"],
                          order=["doc_id", "key", "copy"], rank="slot")
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))
