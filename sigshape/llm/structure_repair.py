"""Conversation structure repair: iterative-deepening A* over edits.

A conversation, a row for each turn, should read: a system turn or none, then
user and assistant in turn, or nothing at all. Every row is kept (cost 0),
given the role that fits (1) or deleted (2); a user or assistant turn without
text may be inserted anywhere (5). Blank rows and later copies of a row must
be deleted; a truncated row that stays costs 5 more. The audit is the row of
edits, by their initials, that costs least; of equal ones the least in ASCII.

``repair`` finds it by depth-first search in that order (D, I, K, R) under a
bound on cost. The estimate of what is left adds up the rows that cost
2 in any case and the disjoint pairs of neighbours that cannot both stay. A
state (row, role before) that fails enters a table with what it costs at
least; the next bound is what the table then says of the start. The first path
accepted is the answer, since no bound exceeds the least cost.

Rows are dealt by ranges of (conversation, turn); duplicates come from a
minimum with map-side combine. The search needs the rows of a conversation in
order, as one byte each with their place: texts never travel with them.

Defined cases: a null role or text is one space, and so is a null id or turn in
the damaging hash; rows without an id are one conversation, of id null; equal
turn numbers go by role, then text; roles count by their first character,
unknown and empty ones fit nowhere; turns that are all null leave no gaps;
gaps beyond a bigint are its greatest value; a conversation that lost all its
rows has zeros; an empty table gives no rows; columns other than the four are
never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved, ship
from .turns import hashed_pieces, in_order

WHITE = " \t\n\x0b\x0c\r"
ENDS = ".!?"

DELETE, RENAME, INSERT, TRUNCATED = 2, 1, 5, 5       # costs
#: What stood before: nothing, system, user, assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: Kinds of rows by the first character of their role; the last stands for any other.
KINDS = "sua-"
#: Faults of rows; the first that holds counts.
NONE, BLANK, DUPLICATE, CUT = range(4)
_FITS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
_LEGAL = {"su", "ua", "au"}
_MOST = (1 << 63) - 1


def turn_after(before: int) -> int:
    """The role that an inserted or renamed turn takes."""
    return ASSISTANT if before == USER else USER


def estimates(kinds: str, faults: bytes) -> list[int]:
    """What the rows from each one on cost at least."""
    n = len(kinds)
    out = [0] * (n + 1)
    pairs, sure = [0] * (n + 1), 0
    follower = None                       # the next row without a fault, if none that is cut lies between
    for i in range(n - 1, -1, -1):
        sure += DELETE * (faults[i] != NONE)
        pairs[i] = pairs[i + 1]
        if faults[i] == CUT:
            follower = None
        elif faults[i] == NONE:
            if follower is not None and kinds[i] + kinds[follower] not in _LEGAL:
                pairs[i] = max(pairs[i], RENAME + pairs[follower + 1])
            follower = i
        out[i] = sure + pairs[i]
    return out


def repair(kinds: str, faults: bytes) -> tuple[int, str]:
    """(cost, audit) of the rows of one conversation."""
    n = len(kinds)
    ahead = estimates(kinds, faults)
    at_end = {START: 0, SYSTEM: 2 * INSERT, USER: INSERT, ASSISTANT: 0}
    least: dict[tuple[int, int], int] = {}

    def bound_of(i: int, before: int) -> int:
        return least.get((i, before), at_end[before] if i == n else ahead[i])

    def edits(i: int, before: int) -> list[tuple[str, int, int, int]]:
        """(initial, next row, what stands before it, cost) in ASCII order."""
        out = [("D", i + 1, before, DELETE)] if i < n else []
        out.append(("I", i, turn_after(before), INSERT))
        if i < n and faults[i] in (NONE, CUT):
            more = TRUNCATED * (faults[i] == CUT)
            kept = _FITS.get((before, kinds[i]))
            if kept is not None:
                out.append(("K", i + 1, kept, more))
            out.append(("R", i + 1, turn_after(before), RENAME + more))
        return out

    bound = bound_of(0, START)
    while True:
        # A frame: row, role before, budget left, edits, the next one to try, the least cost seen.
        stack: list[list] = [[0, START, bound, edits(0, START), 0, None]]
        path: list[tuple[str, int]] = []
        while stack:
            frame = stack[-1]
            i, before, left, options, k, seen = frame
            if i == n and before in (START, ASSISTANT):
                return bound, "".join(letter for letter, _ in path)
            if k == len(options):                        # failed: it costs more than is left
                least[i, before] = max(bound_of(i, before), seen)
                stack.pop()
                if stack:
                    cheapest = path.pop()[1] + least[i, before]
                    stack[-1][5] = cheapest if stack[-1][5] is None else min(stack[-1][5], cheapest)
                continue
            letter, j, then, cost = options[k]
            frame[4] += 1
            cheapest = cost + bound_of(j, then)
            if cheapest <= left:
                stack.append([j, then, left - cost, edits(j, then), 0, None])
                path.append((letter, cost))
            else:
                frame[5] = cheapest if seen is None else min(seen, cheapest)
        bound = least[0, START]


def edited(kinds: str, audit: str) -> Iterator[tuple[int, bool, str | None]]:
    """The repaired turns: (row, inserted, role or None for the row's own);
    an inserted turn stands before that row's own, or after the last row."""
    i, before = 0, START
    for letter in audit:
        if letter == "I":
            before = turn_after(before)
            yield i, True, ROLES[before]
        else:
            if letter == "K":
                before = _FITS[before, kinds[i]]
                yield i, False, None
            elif letter == "R":
                before = turn_after(before)
                yield i, False, ROLES[before]
            i += 1


class Repair(NamedTuple):
    """``report``: one row per conversation that has rows: conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit. ``turns``: the repaired
    conversations, (conv_id, at, k, role, text), in order of (at, k)."""
    report: DataFrame
    turns: DataFrame


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _searched(kind: str):
    """Rows (conv_id, at, turn, code) by conversation and place -> its report
    (audit not null) and its turns."""
    columns = ["conv_id", "at", "k", "inserted", "role", *_COUNTS, "audit"]
    types = [None, pa.int64(), pa.int32(), pa.bool_(), pa.string(), *[pa.int64()] * len(_COUNTS), pa.string()]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_type, of, rows = None, None, []
        codes, places = bytearray(), []
        low, high, last, distinct = None, None, None, 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], types[j] or conv_type) for j in range(len(columns))], columns)

        def finished() -> Iterator[pa.RecordBatch]:
            nonlocal rows
            kinds = "".join(KINDS[c >> 2] for c in codes)
            faults = bytes(c & 3 for c in codes)
            cost, audit = repair(kinds, faults)
            gaps = min(high - low + 1 - distinct, _MOST) if distinct else 0
            illegal = sum(kinds[j:j + 2] not in _LEGAL for j in range(len(kinds) - 1))
            rows.append((of, None, None, None, None, gaps, faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT),
                         illegal, cost, audit))
            seen, k = None, 0
            for i, inserted, role in edited(kinds, audit):
                after = i == len(places)
                k = k + 1 if i == seen else 0
                seen = i
                rows.append((of, places[-1] if after else places[i], k + (1 << 20 if after else 0), inserted, role, *[None] * 7))
                if len(rows) >= 10_000:
                    yield batch()
                    rows = []

        for b in batches:
            conv_type = b.schema.field(0).type
            for conv, at, turn, code in zip(*[b.column(j).to_pylist() for j in range(4)]):
                if codes and conv != of:
                    yield from finished()
                    codes, places = bytearray(), []
                    low, high, last, distinct = None, None, None, 0
                of = conv
                codes.append(code)
                places.append(at)
                if turn is not None and turn != last:
                    low, high, last, distinct = (turn if low is None else low), turn, turn, distinct + 1
        if codes:
            yield from finished()
        if rows:
            yield batch()

    return search, f"conv_id {kind}, at bigint, k int, inserted boolean, role string, {', '.join(f'{c} bigint' for c in _COUNTS)}, audit string"


def _rows(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    space = lambda c: F.coalesce(F.col(c), F.lit(" "))
    return conversations.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                                space(role_col).alias("role"), space(text_col).alias("text"))


def repair_conversations(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> Repair:
    """The repair of every conversation."""
    ship(conversations.sparkSession)
    turns = _rows(conversations, conv_col, turn_col, role_col, text_col)
    key = F.unhex(F.sha2(F.concat(F.col("conv_id").isNull().cast("string"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")),
                                  F.lit(":"), F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    rows = in_order(turns, {"turn": F.col("turn"), "role": F.col("role"), "text": F.col("text"), "same": key}, "repair-turns")
    copies = saved(rows.groupBy("same").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
                   .select(F.col("same").alias("of"), "first"), "repair-copies")
    shown = F.rtrim("text", F.lit(WHITE))
    fault = (F.when(shown == "", BLANK).when(F.col("first").isNotNull() & (F.col("at") > F.col("first")), DUPLICATE)
             .when(~F.right(shown, F.lit(1)).isin(*ENDS), CUT).otherwise(NONE))
    initial = F.left("role", F.lit(1))
    kind_of = F.lit(len(KINDS) - 1)
    for k, c in enumerate(KINDS[:-1]):
        kind_of = F.when(initial == c, k).otherwise(kind_of)
    coded = rows.join(copies, F.col("same") == F.col("of"), "left").select("conv_id", "at", "turn", (kind_of * 4 + fault).alias("code"))
    search, schema = _searched(rows.schema["conv_id"].dataType.simpleString())
    found = saved(coded.repartition("conv_id").sortWithinPartitions("conv_id", "at").mapInArrow(search, schema), "repair-found", clean=True)
    report = found.where("audit IS NOT NULL").select("conv_id", *_COUNTS, "audit")
    own = rows.select(F.col("at").alias("of"), F.col("role").alias("own"), "text")
    kept = (found.where("audit IS NULL AND NOT inserted").join(own, F.col("at") == F.col("of"))
            .select("conv_id", "at", "k", F.coalesce("role", "own").alias("role"), "text"))
    new = found.where("audit IS NULL AND inserted").select("conv_id", "at", "k", "role", F.lit("").alias("text"))
    return Repair(report, kept.unionByName(new))


def damaged(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """The rows with planted faults, by crc32 of ``conv_id:turn`` modulo 20: 0
    drops a row, 1 empties its text, 2 removes its sentence ends, 3 repeats it,
    4 makes it a user's."""
    rows = _rows(conversations, conv_col, turn_col, role_col, text_col)
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.withColumn("hit", F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20)
    copies = F.when(F.col("hit") == 0, 0).when(F.col("hit") == 3, 2).otherwise(1)

    def text() -> Column:
        return (F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text")))

    return rows.select("conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"), text().alias("text"),
                       F.explode(F.array_repeat(F.lit(0), copies)).alias("copy")).drop("copy")


def repair_report(conversations: DataFrame, repaired: Repair, conv_col: str = "conv_id") -> DataFrame:
    """One row per conversation of ``conversations``: its report and
    repaired_sha256, the hash of its repaired ``role:text`` lines."""
    line = F.concat("role", F.lit(":"), "text")
    hashes = hashed_pieces(repaired.turns.select(F.col("conv_id").alias("key"), "at", "k", line.alias("piece")), "\n", ("at", "k"))
    every = conversations.select(F.col(conv_col).alias("conv_id")).distinct()
    report = repaired.report.withColumnRenamed("conv_id", "of")
    hashes = hashes.withColumnRenamed("key", "of_hash")
    out = (every.join(report, F.col("conv_id").eqNullSafe(F.col("of")), "left")
           .join(hashes, F.col("conv_id").eqNullSafe(F.col("of_hash")), "left"))
    return out.select("conv_id", *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in _COUNTS],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
