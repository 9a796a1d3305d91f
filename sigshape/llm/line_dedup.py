"""Line dedup: winnowing over line hashes.

A document is its sequence of non-blank lines, trimmed. Of every ``WINDOW``
consecutive line hashes the least (the rightmost of equals) is selected as
the window's fingerprint, so two places that share a run of ``WINDOW`` lines
select the same fingerprint there. A line of ``LONG_WORDS`` words or more
is a window, and a fingerprint, of its own. There is one row per selected
position, with the range of the windows that selected it; positions whose
fingerprint stands at one position only are dropped.

The positions of a shared fingerprint are joined to the first place in the
corpus (least id, then position) where it stands among the same lines, those
of a window that selected it: a common line such as a closing bracket has its
first place among other lines, and a run that stands in two later documents
would be lost there. Matches on one diagonal that touch are one run; a run is
extended both ways, line by line, as long as both places agree, and the
later place's lines are deleted. The first place of a line always stays.

``SHORT`` adds the shorter runs: a line, or two lines together, of ``run_words``
words are windows too, and so is a line of ``line_words`` words that stands at
``often`` places or more. All are extended like the others. What stays out:
runs of one or two lines under ``run_words`` words, unless one of the lines
is such an often repeated one.

DataFrame functions only. A text's lines are hashed once, into one written
row; windows are compared by the hashes of their lines (64 bits a line, 128
for a line alone). All groupings are minima with map-side combine, and the
joins back to the positions are joins of written tables, whose hot keys AQE
splits, so a line that stands in a third of all documents costs one row each.

Defined cases: a null or empty text has no lines; blank lines take no part
and stay; lines are equal if their trimmed texts are; a null id comes
first; rows of equal id and text are one document and have equal results;
one very long document is one row's arrays; an empty table gives no rows;
``dedup_lines`` returns a row per document with the columns it names.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import saved, text_of

#: Shortest run, in lines, that is found wherever it stands.
WINDOW = 3
#: A line of so many words is found alone.
LONG_WORDS = 25


class Short(NamedTuple):
    """Which runs of fewer than ``WINDOW`` lines are found as well."""
    run_words: int = 8      # words of a line, or of two lines together
    line_words: int = 3     # words of a line that stands at many places
    often: int = 10         # so many


SHORT = Short()
_BLANKS = " \t\r\x0b\x0c"


def _lines(text: Column) -> Column:
    """Array of (line, t) of the non-blank lines: number and trimmed text."""
    every = F.transform(F.split(text, "\n", -1), lambda x, i: F.struct(i.alias("line"), F.btrim(x, F.lit(_BLANKS)).alias("t")))
    return F.filter(every, lambda x: x["t"] != "")


def line_hashes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document: doc_id, key (hash of the text), and of every
    line its hash ``h``, a second one ``g`` and its number of words ``n``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    odd = F.contains("text", F.lit("  "))
    for c in "\t\x0b\x0c\r":
        odd = odd | F.contains("text", F.lit(c))
    rows = rows.select("doc_id", F.xxhash64("text").alias("key"), odd.alias("odd"), _lines(F.col("text")).alias("lines"))

    def hashed(n_words) -> Column:
        return F.transform("lines", lambda x: F.struct(
            F.xxhash64(x["t"]).alias("h"), F.xxhash64(F.lit(1), x["t"]).alias("g"), n_words(x["t"]).alias("n")))

    # Most texts have single blanks only, which are counted; the others are split.
    blanks = lambda t: F.char_length(t) - F.char_length(F.replace(t, F.lit(" "), F.lit(""))) + 1
    words = lambda t: F.size(F.split(t, "[\\x20\\x09-\\x0D]+"))
    return rows.select("doc_id", "key", F.when(F.col("odd"), hashed(words)).otherwise(hashed(blanks)).alias("lines")).distinct()


def positions(hashed: DataFrame, window: int, long_words: int, short: Short | None = None) -> DataFrame:
    """One row per selected position: doc_id, key, fingerprint, at; the
    windows of ``window`` lines that selected it begin at ``lo`` to ``hi``,
    those of two lines if ``pair_lo`` to ``pair_hi``; ``alone``: 1 if the line
    is a window of its own, 2 if it is one at many places; ``g``, and the
    hashes ``near`` it, which begin at line ``base``."""
    alone_words = min(long_words, short.run_words) if short else long_words
    least = min(alone_words, short.line_words) if short else long_words
    pairs = short is not None and window > 2
    x, size = F.col("lines"), F.size("lines")

    def at(i: Column) -> Column:
        own = F.get(x, i)
        h = own["h"]
        # Lines on either side that leave this one the least: equals on the left, none on the right.
        left = right = F.lit(0)
        for k in range(window - 1, 0, -1):
            left = F.when(F.get(x, i - k)["h"] >= h, left + 1).otherwise(0)
            right = F.when(F.get(x, i + k)["h"] > h, right + 1).otherwise(0)
        lo = i - left
        hi = F.least(i, i + right - (window - 1))
        two = [F.lit(None).cast("int")] * 2
        if pairs:
            before, after = F.get(x, i - 1), F.get(x, i + 1)
            first = (before["h"] >= h) & (before["n"] + own["n"] >= short.run_words)
            second = (after["h"] > h) & (after["n"] + own["n"] >= short.run_words)
            two = [F.when(first, i - 1).when(second, i), F.when(second, i).when(first, i - 1)]
        alone = F.when(own["n"] >= alone_words, 1).when(own["n"] >= least, 2).otherwise(0)
        base = F.greatest(i - (window - 1), F.lit(0))
        near = F.transform(F.slice(x, base + 1, i - base + window), lambda y: y["h"])
        return F.struct(h.alias("fingerprint"), i.alias("at"), lo.alias("lo"), hi.alias("hi"), two[0].alias("pair_lo"), two[1].alias("pair_hi"),
                        alone.alias("alone"), own["g"].alias("g"), base.alias("base"), near.alias("near"))

    every = F.transform(F.sequence(F.lit(0), size - 1), at)
    chosen = F.filter(every, lambda p: (p["lo"] <= p["hi"]) | p["pair_lo"].isNotNull() | (p["alone"] > 0))
    return hashed.where(size > 0).select("doc_id", "key", F.inline(chosen))


def windows(chosen: DataFrame, window: int) -> DataFrame:
    """The windows of selected positions: doc_id, key, first, n, same (what
    tells their lines) and rare (whether it counts only at many places)."""
    def run(first: Column, n: int) -> Column:
        return F.struct(first.alias("first"), F.lit(n).alias("n"), F.slice("near", first - F.col("base") + 1, n).alias("same"),
                        F.lit(False).alias("rare"))

    none = F.array().cast("array<struct<first:int,n:int,same:array<bigint>,rare:boolean>>")
    long = F.when(F.col("lo") <= F.col("hi"), F.transform(F.sequence("lo", "hi"), lambda f: run(f, window))).otherwise(none)
    two = F.when(F.col("pair_lo").isNotNull(), F.transform(F.sequence("pair_lo", "pair_hi"), lambda f: run(f, 2))).otherwise(none)
    one = F.when(F.col("alone") > 0, F.array(F.struct(
        F.col("at").alias("first"), F.lit(1).alias("n"), F.array("fingerprint", "g").alias("same"), (F.col("alone") == 2).alias("rare"))))
    return chosen.select("doc_id", "key", F.inline(F.concat(long, two, F.coalesce(one, none))))


def _agreeing(a: Column, b: Column) -> Column:
    """How many leading elements of two arrays agree."""
    k = F.least(F.size(a), F.size(b))
    same = F.zip_with(F.slice(a, 1, k), F.slice(b, 1, k), lambda x, y: x == y)
    first = F.array_position(same, False).cast("int")
    return F.when(first == 0, k).otherwise(first - 1)


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                  long_words: int = LONG_WORDS, short: Short | None = None) -> DataFrame:
    """(doc_id, key, first, end) of every later repeated run, in non-blank
    lines; key is the 64-bit hash of the text."""
    hashed = saved(line_hashes(docs, id_col, text_col), "lines-hashes")
    chosen = saved(positions(hashed, window, long_words, short), "lines-positions")

    place = F.xxhash64("doc_id", "key", "at")
    shared = saved(chosen.groupBy("fingerprint").agg(F.min(place).alias("lo"), F.max(place).alias("hi"))
                   .where("lo <> hi").select(F.col("fingerprint").alias("of")), "lines-shared")
    candidates = chosen.join(shared, F.col("fingerprint") == F.col("of"), "left_semi")
    candidates = saved(windows(candidates, window), "lines-candidates")
    if short:
        many = saved(candidates.where("rare").groupBy("same").agg(F.count_distinct(F.struct("doc_id", "key", "first")).alias("places"))
                     .where(F.col("places") >= short.often).select(F.col("same").alias("as")), "lines-often")
        candidates = candidates.where("not rare").unionByName(
            candidates.where("rare").join(many, F.col("same") == F.col("as"), "left_semi"))
    first = (candidates.groupBy("n", "same").agg(F.min(F.struct("doc_id", "key", "first")).alias("src"))
             .select(F.col("n").alias("as_n"), F.col("same").alias("as"), "src"))
    first = saved(first, "lines-first")       # a plain table, so that the join can split a hot line
    later = (candidates.join(first, (F.col("same") == F.col("as")) & (F.col("n") == F.col("as_n")))
             .where(F.struct("doc_id", "key", "first") != F.col("src"))
             .select("doc_id", "key", "first", (F.col("first") + F.col("n")).alias("end"),
                     F.col("src.doc_id").alias("src_id"), F.col("src.key").alias("src_key"),
                     (F.col("first") - F.col("src.first")).alias("shift")))

    # Touching matches on one diagonal are one run.
    diagonal = Window.partitionBy("doc_id", "key", "src_id", "src_key", "shift").orderBy("first", "end")
    reach = F.max("end").over(diagonal.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(F.col("first") <= reach, 0).otherwise(1)
    runs = (later.withColumn("begins", begins)
            .withColumn("run", F.sum("begins").over(diagonal.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy("doc_id", "key", "src_id", "src_key", "shift", "run")
            .agg(F.min("first").alias("first"), F.max("end").alias("end")))

    # Extension both ways against the line hashes of both places.
    h = F.transform("lines", lambda x: x["h"])
    here = hashed.select(F.col("doc_id").alias("h_id"), F.col("key").alias("h_key"), h.alias("here"))
    there = hashed.select(F.col("doc_id").alias("t_id"), F.col("key").alias("t_key"), h.alias("there"))
    both = (runs.join(here, F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("key") == F.col("h_key")))
            .join(there, F.col("src_id").eqNullSafe(F.col("t_id")) & (F.col("src_key") == F.col("t_key"))))
    src_first, src_end = F.col("first") - F.col("shift"), F.col("end") - F.col("shift")
    back = _agreeing(F.reverse(F.slice("here", 1, F.col("first"))), F.reverse(F.slice("there", 1, src_first)))
    ahead = _agreeing(F.slice("here", F.col("end") + 1, F.size("here")), F.slice("there", src_end + 1, F.size("there")))
    return both.select("doc_id", "key", (F.col("first") - back).alias("first"), (F.col("end") + ahead).alias("end"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                long_words: int = LONG_WORDS, short: Short | None = None) -> DataFrame:
    """One row per document: doc_id, n_lines, n_deleted, deleted (numbers of
    the deleted lines), text (without them). ``short`` adds the shorter runs."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    rows = rows.withColumn("key", F.xxhash64("text"))
    runs = repeated_runs(docs, id_col, text_col, window, long_words, short)
    of = (runs.groupBy("doc_id", "key").agg(F.collect_set(F.struct("first", "end")).alias("runs"))
          .select(F.col("doc_id").alias("r_id"), F.col("key").alias("r_key"), "runs"))
    out = rows.join(of, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("key") == F.col("r_key")), "left")
    every = F.split("text", "\n", -1)
    numbers = F.transform(_lines(F.col("text")), lambda x: x["line"])
    gone = F.filter(numbers, lambda x, i: F.exists("runs", lambda r: (r["first"] <= i) & (i < r["end"])))
    out = out.withColumn("gone", F.when(F.col("runs").isNotNull(), gone).otherwise(F.array().cast("array<int>")))
    kept = F.array_join(F.filter(every, lambda x, i: ~F.array_contains(F.col("gone"), i)), "\n")
    n_lines = F.char_length("text") - F.char_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    return out.select(
        "doc_id", F.when(F.col("text") == "", 0).otherwise(n_lines).cast("bigint").alias("n_lines"),
        F.size("gone").cast("bigint").alias("n_deleted"), F.array_join(F.col("gone").cast("array<string>"), ",").alias("deleted"),
        F.when(F.size("gone") > 0, kept).otherwise(F.col("text")).alias("text"))
