"""Benchmark decontamination: a positional inverted index of the corpus.

Words are runs of letters, digits and non-ASCII characters, A-Z in lower
case. An item's windows are its runs of ``WINDOW`` consecutive words (all of
its words, if fewer). A window is looked up by its rarest term, as counted in
the corpus: only those terms' postings are stored. A posting (document, term,
position) is adjusted by the term's offsets in the windows it stands for and
carries the phrase that begins there, so the intersection of the ten
offset-adjusted lists is one equality of phrases. Exact phrase matches mark
the words they cover; a proximity match is a window whose terms all stand
within ``REACH`` words of a posting of its rarest term, in any order.

DataFrame functions only. A document's terms are first tested against a bit
set of fixed size (``FILTER_WORDS`` bigints, whatever the benchmark's size):
a false hit costs time, never a result, since the joins compare whole
terms and phrases. Joins are left to Spark's size-checked choice: the small
sides are written tables.

Defined cases: a null text has no words; an empty item has no window;
repeated items count once per item id, items without an id count in no list;
repeated or null document ids are told apart by their text; repeated rows
give repeated rows; a very long text is one row's array; empty tables give
no rows or no hits; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, saved, text_of
from .decisions import drop_rows, text_key

WINDOW = 10
#: Words on either side of a rarest term that a proximity match may use.
REACH = 15
#: Size of the bit sets that pre-filter terms: 2048 bigints, 131,072 bits.
FILTER_WORDS = 2048

NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), NOT_WORD, -1), "")


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def bit_set(hashes: DataFrame) -> list[int]:
    """A fixed-size bit set over the values of a one-column frame."""
    h = F.col(hashes.columns[0])
    word = F.shiftrightunsigned(h, 6).bitwiseAND(F.lit(FILTER_WORDS - 1)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), h.bitwiseAND(F.lit(63)).cast("int"))
    got = {r.w: r.b for r in hashes.select(word.alias("w"), bit.alias("bit")).groupBy("w")
           .agg(F.bit_or("bit").alias("b")).collect()}                # FILTER_WORDS rows at most
    return [got.get(i, 0) for i in range(FILTER_WORDS)]


def in_bit_set(h: Column, bits: Column) -> Column:
    word = F.shiftrightunsigned(h, 6).bitwiseAND(F.lit(FILTER_WORDS - 1)).cast("int")
    return F.getbit(F.get(bits, word), h.bitwiseAND(F.lit(63)).cast("int")) == 1


def _literal(bits: list[int]) -> Column:
    """The bit set as one literal array."""
    return F.from_json(F.lit(str(bits)), F.lit("array<bigint>"))


def item_windows(items: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """(item_id, phrase, terms) of every window of every item."""
    words = items.select(F.col(item_col).cast("string").alias("item_id"), words_of(text_of(text_col)).alias("words"))
    words = words.where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1)))
    return (words.select("item_id", "words", F.explode(starts).alias("at"))
            .select("item_id", F.slice("words", F.col("at"), window).alias("terms"))
            .select("item_id", F.array_join("terms", " ").alias("phrase"), "terms").distinct())


def rarest_terms(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(phrase, terms, anchor, at): every window with its rarest term in the
    corpus (ties: the lesser term) and that term's first place in it."""
    terms = windows.select("phrase", F.posexplode("terms").alias("at", "term"))
    vocabulary = saved(terms.select("term").distinct().withColumn("h", F.xxhash64("term")), "index-vocabulary")
    bits = _literal(bit_set(vocabulary.select("h")))
    known = F.filter(_hashes(words_of(F.col("text"))), lambda h: in_bit_set(h, bits))
    seen = docs.select(F.explode(known).alias("seen")).groupBy("seen").agg(F.count(F.lit(1)).alias("n"))
    counted = saved(vocabulary.join(seen, F.col("h") == F.col("seen"), "left")
                    .select(F.col("term").alias("of"), F.coalesce("n", F.lit(0)).alias("n")), "index-counts")
    rarest = (terms.join(counted, F.col("term") == F.col("of"))
              .groupBy("phrase").agg(F.min(F.struct("n", "term", "at")).alias("r"))
              .select(F.col("phrase").alias("p"), F.col("r.term").alias("anchor"), F.col("r.at").alias("at")))
    return (windows.select("phrase", "terms").distinct().join(rarest, F.col("phrase") == F.col("p"))
            .select("phrase", "terms", "anchor", "at"))


def postings(docs: DataFrame, anchors: DataFrame, reach: int) -> DataFrame:
    """One row per document: its word count, and its postings of anchor terms.

    A posting has its position, the word hashes around it, and the phrases
    that begin where a window with this term may begin.
    """
    places = sorted({(r.at, r.n) for r in anchors.select("at", F.size("terms").alias("n")).distinct().collect()})
    bits = _literal(bit_set(anchors.select(F.xxhash64("anchor").alias("h")).distinct()))
    placed = _literal(bit_set(anchors.select(F.xxhash64(F.xxhash64("anchor"), "at", F.size("terms")).alias("h")).distinct()))
    words = docs.select("doc_id", "key", words_of(F.col("text")).alias("words"))
    words = words.select("doc_id", "key", "words", _hashes(F.col("words")).alias("hashes"))
    n = F.size("words")
    at = F.filter(F.transform("hashes", lambda h, i: F.when(in_bit_set(h, bits), i)), lambda i: i.isNotNull())

    def phrase(i: Column, place: Column) -> Column:
        first = i - place["at"]
        ok = ((first >= 0) & (first + place["n"] <= n)
              & in_bit_set(F.xxhash64(F.get("hashes", i), place["at"], place["n"]), placed))
        return F.when(ok, F.struct(first.alias("first"), place["n"].alias("n"),
                                   F.array_join(F.slice("words", first + 1, place["n"]), " ").alias("phrase")))

    allowed = F.array(*[F.struct(F.lit(a).alias("at"), F.lit(k).alias("n")) for a, k in places])
    posting = F.transform(at, lambda i: F.struct(
        i.alias("at"), F.get("hashes", i).alias("term"),
        F.slice("hashes", F.greatest(i - reach, F.lit(0)) + 1,
                F.lit(reach + 1) + F.least(i, F.lit(reach))).alias("near"),
        F.filter(F.transform(allowed, lambda place: phrase(i, place)), lambda p: p.isNotNull()).alias("phrases")))
    return words.select("doc_id", "key", n.cast("bigint").alias("n_words"),
                        (posting if places else F.lit(None)).alias("postings"))


def _covered(spans: Column) -> Column:
    """Words covered by an array of (first, n), overlaps counted once."""
    return F.aggregate(
        F.array_sort(spans), F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n")),
        lambda acc, s: F.struct(F.greatest(acc["end"], s["first"] + s["n"]).alias("end"),
                                (acc["n"] + F.greatest(s["first"] + s["n"] - F.greatest(s["first"], acc["end"]),
                                                       F.lit(0))).alias("n")),
        lambda acc: acc["n"])


def _contamination(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str,
                   window: int, reach: int) -> DataFrame:
    """``contamination`` with ``key``, the 64-bit hash of the text."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    rows = rows.withColumn("key", text_key("text"))
    windows = saved(item_windows(items, item_col, item_text_col, window), "index-windows")
    if windows.isEmpty():
        index, anchors = rows.select("doc_id", "key", F.size(words_of(F.col("text"))).cast("bigint").alias("n_words")), None
    else:
        anchors = saved(rarest_terms(rows, windows), "index-anchors")
        index = saved(postings(rows, anchors, reach), "index-postings")
    base = index.select("doc_id", "key", "n_words")
    if anchors is None:
        return base.select("doc_id", "key", "n_words", F.lit(0).cast("bigint").alias("n_hit"),
                           F.lit(0).cast("bigint").alias("n_items"), F.sha2(F.lit(""), 256).alias("items_sha256"),
                           F.lit(False).alias("contaminated"), F.lit(0).cast("bigint").alias("n_near"))
    each = index.select("doc_id", "key", F.explode("postings").alias("p"))

    # Exact phrases.
    begun = each.select("doc_id", "key", F.explode("p.phrases").alias("b"))
    phrases = anchors.select(F.col("phrase").alias("of")).distinct()
    exact = saved(begun.select("doc_id", "key", "b.first", "b.n", "b.phrase")
                  .join(phrases, F.col("phrase") == F.col("of"), "left_semi"), "index-exact")
    hit = (exact.groupBy("doc_id", "key").agg(F.collect_set(F.struct("first", "n")).alias("spans"))
           .select("doc_id", "key", _covered(F.col("spans")).alias("n_hit")))
    of_item = windows.where("item_id is not null").select("item_id", F.col("phrase").alias("of"))
    found = (exact.select("doc_id", "key", "phrase").distinct().join(of_item, F.col("phrase") == F.col("of"))
             .select("doc_id", "key", "item_id").distinct()
             .groupBy("doc_id", "key").agg(F.array_sort(F.collect_list("item_id")).alias("ids"))
             .select("doc_id", "key", F.size("ids").cast("bigint").alias("n_items"),
                     F.sha2(F.array_join("ids", ","), 256).alias("items_sha256")))

    # Proximity: every term of the window near a posting of its rarest term.
    wanted = anchors.select(F.xxhash64("anchor").alias("of"), F.col("phrase").alias("near_phrase"),
                            _hashes(F.col("terms")).alias("terms"))
    near = (each.select("doc_id", "key", "p.term", "p.near")
            .join(wanted, (F.col("term") == F.col("of")) & (F.size(F.array_except("terms", "near")) == 0))
            .select("doc_id", "key", "near_phrase").distinct()
            .join(of_item, F.col("near_phrase") == F.col("of")).select("doc_id", "key", "item_id").distinct()
            .groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("n_near")))

    def beside(left: DataFrame, right: DataFrame) -> DataFrame:
        r = right.withColumnsRenamed({"doc_id": "r_id", "key": "r_key"})
        return left.join(r, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("key") == F.col("r_key")),
                         "left").drop("r_id", "r_key")

    out = beside(beside(beside(base, hit), found), near)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c)
    return out.select("doc_id", "key", "n_words", zero("n_hit"), zero("n_items"),
                      F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
                      F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"), zero("n_near"))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  reach: int = REACH) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated, and n_near (items with a proximity match)."""
    return _contamination(docs, items, id_col, text_col, item_col, item_text_col, window, reach).drop("key")


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without those that hold a window of an item; all columns stay."""
    found = _contamination(docs, items, id_col, text_col, "item_id", "text", WINDOW, REACH)
    return drop_rows(docs, found.where("contaminated").select("doc_id", "key"), id_col, text_col)
