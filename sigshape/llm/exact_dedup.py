"""Exact dedup: group by a 128-bit content hash, keep one row per content.

Texts are equal when they are byte-identical after deleting white space
(``[\\x20\\x09-\\x0D]``). Of equal texts the longest original (code points)
stays, then the one with the smallest id, then with the least text hash.

Plan: one narrow table (hash, id, length) is written; groups are counted with
map-side combine, so a group holding a third of all rows reaches the shuffle
as one row per task; the join back to the members is a plain sort-merge join
whose hot partition AQE splits. Hash equality is never trusted: of every group
of two or more the texts themselves are compared (a distinct with map-side
combine, so a task sends one copy of each), and a group whose bytes differ is
split by its texts. Texts without a partner never leave their task.

Defined cases: a null text is an empty text; empty texts equal each other;
a null id sorts after all others; of repeated rows (same id, same content)
one is kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, saved, text_of
from .decisions import drop_rows, text_key

#: Groups of two or more whose hashes are broadcast (16 MB), to tell which rows
#: have a partner; more groups are joined by a shuffle.
PARTNER_GROUPS = 2_000_000


def content_md5(norm: Column) -> Column:
    return F.unhex(F.md5(norm))


def _differing(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Hashes whose group holds more than one byte sequence.

    Of ``rows`` (hash, norm) only those in a group of two or more are looked
    at, however many groups there are: their hashes, as 64 bits, are
    broadcast up to a checked number, and joined by a shuffle beyond it. A task
    sends one copy of each text; a hash with two texts differs.
    """
    partners = saved(groups.where("group_size > 1").select(F.xxhash64("hash").alias("of")), "exact-partners")
    if partners.count() <= PARTNER_GROUPS:
        partners = F.broadcast(partners)
    return (rows.select("hash", "norm").join(partners, F.xxhash64("hash") == F.col("of"), "left_semi")
            .distinct().groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash"))


def _members(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    """Documents folded by (content, id, text) with their group: doc_id, key,
    keep_id, keep_key, group_size, sha, n_rows."""
    norm = F.regexp_replace(text_of(text_col), WHITE, "")
    rows = docs.select(F.col(id_col).alias("doc_id"), text_key(text_col).alias("key"), norm.alias("norm"),
                       F.char_length(text_of(text_col)).alias("n_chars"))
    rows = rows.withColumn("hash", digest(F.col("norm")))

    def members(extra: list[Column]) -> DataFrame:
        """Rows folded by (content, id, text): repeated rows are counted."""
        return saved(rows.select("hash", "doc_id", "key", "n_chars", F.unhex(F.sha2("norm", 256)).alias("sha"), *extra)
                     .groupBy("hash", "doc_id", "key", "sub", "sha")
                     .agg(F.max("n_chars").alias("n_chars"), F.count(F.lit(1)).alias("n_rows")),
                     "exact-members")

    def best(m: DataFrame) -> DataFrame:
        """The groups as a plain table, so that the join can split the members of a hot one."""
        return saved(m.groupBy("hash", "sub").agg(
            F.sum("n_rows").alias("group_size"),
            F.min(F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), "doc_id", "key")).alias("first")), "exact-groups")

    folded = members([F.lit(None).cast("string").alias("sub")])
    groups = best(folded)
    differing = saved(_differing(rows, groups), "exact-differing")
    if not differing.isEmpty():            # a hash collision: the bytes join the key
        split = differing.select(F.col("hash").alias("bad"))
        rows = rows.join(split, F.col("hash") == F.col("bad"), "left")
        folded = members([F.when(F.col("bad").isNotNull(), F.col("norm")).alias("sub")])
        groups = best(folded)
    g = groups.select(F.col("hash").alias("g_hash"), F.col("sub").alias("g_sub"), "group_size",
                      F.col("first.doc_id").alias("keep_id"), F.col("first.key").alias("keep_key"))
    on = (F.col("hash") == F.col("g_hash")) & F.col("sub").eqNullSafe(F.col("g_sub"))
    return folded.join(g, on).select("doc_id", "key", "keep_id", "keep_key", "group_size", "sha", "n_rows")


def _kept() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("key") == F.col("keep_key"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 digest: Callable[[Column], Column] = content_md5) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    ``digest`` gives the group hash (binary); only tests change it.
    """
    return (_members(docs, id_col, text_col, digest)
            .select("doc_id", "keep_id", "group_size", _kept().alias("first"), F.lower(F.hex("sha")).alias("text_sha256"),
                    F.explode(F.sequence(F.lit(1).cast("bigint"), "n_rows")).alias("copy"))
            .select("doc_id", "keep_id", "group_size", (F.col("first") & (F.col("copy") == 1)).alias("kept"), "text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that an equal text outranks; all columns stay."""
    dropped = _members(docs, id_col, text_col, content_md5).where(~_kept()).select("doc_id", "key")
    return drop_rows(docs, dropped, id_col, text_col, once=True)
