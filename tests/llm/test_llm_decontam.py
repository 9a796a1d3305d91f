"""Decontamination against brute force, exact and near."""
import hashlib
from collections import Counter

from llm_helpers import EDGE, SF_SMALL, contract_words, docs_frame, small_documents

from sigshape.llm.decontam import contamination, drop_contaminated


def brute(docs, items, window=10, reach=15):
    freq = Counter(w for _, t in docs for w in contract_words(t))
    wins = {}
    for item, t in items:
        w = contract_words(t)
        for s in range(max(1, len(w) - window + 1)):
            if w:
                wins.setdefault(tuple(w[s:s + window]), set()).add(item)
    out = []
    for i, t in docs:
        w = contract_words(t)
        hit, found, near = set(), set(), set()
        for phrase, owners in wins.items():
            k = len(phrase)
            starts = [s for s in range(len(w) - k + 1) if tuple(w[s:s + k]) == phrase] if phrase[0] in w else []
            for s in starts:
                hit.update(range(s, s + k))
            owners = {o for o in owners if o is not None}
            if starts:
                found |= owners
            anchor = min(phrase, key=lambda x: (freq[x], x))
            if any(set(phrase) <= set(w[max(0, p - reach):p + reach + 1]) for p, x in enumerate(w) if x == anchor):
                near |= owners
        ids = sorted(str(x) for x in found)
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit), len(near)))
    return sorted(out, key=repr)


def got(df):
    return sorted([tuple(r) for r in df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256",
                                               "contaminated", "n_near").collect()], key=repr)


ITEMS = "item_id bigint, text string, phrase string, anchor string"
LONG = "the quick brown fox jumps over the lazy dog and then it sleeps for a while"


def items_frame(spark, rows):
    return spark.createDataFrame([(i, t, "p", "a") for i, t in rows], ITEMS)


def test_planted_cases(spark):
    items = [(1, LONG), (2, "The QUICK brown; fox jumps over-the lazy dog and then"), (3, "short item"), (4, ""), (5, None),
             (6, "the the the the the the the the the the the"), (1, LONG), (None, "short item"), (7, "É È")]
    shuffled = " ".join(reversed(LONG.split()))
    docs = [(10, "x " * 30 + LONG.upper() + " y" * 9), (11, LONG[:45]), (12, "a short\nitem, short item short"), (13, shuffled),
            (14, "the " * 25), (15, "é è É È"), (16, LONG + ". " + LONG), (17, None), (18, ""), (18, LONG), (18, LONG),
            (None, "short item"), (None, "short item"), (None, "clean"), (19, "clean words only")]
    assert got(contamination(docs_frame(spark, docs), items_frame(spark, items))) == brute(docs, items)


def test_edges_and_empty_tables(spark):
    items = [(1, "one two three"), (2, "word word word")]
    assert got(contamination(docs_frame(spark, EDGE), items_frame(spark, items))) == brute(EDGE, items)
    assert got(contamination(docs_frame(spark, EDGE), items_frame(spark, []))) == brute(EDGE, [])
    assert got(contamination(docs_frame(spark, EDGE), items_frame(spark, [(1, "?!")]))) == brute(EDGE, [])
    assert got(contamination(docs_frame(spark, []), items_frame(spark, items))) == []


def test_small_table(spark):
    docs = small_documents(spark)
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert got(contamination(docs, items)) == want
    assert any(w[5] for w in want)
    out = drop_contaminated(docs, items)
    assert out.schema == docs.schema
    assert sorted(r.doc_id for r in out.collect()) == sorted(w[0] for w in want if not w[5])


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    """Bit sets of one word let almost everything pass: results stay."""
    import sigshape.llm.decontam as m
    monkeypatch.setattr(m, "FILTER_WORDS", 1)
    items = [(1, LONG), (3, "short item")]
    docs = [(10, "x " * 30 + LONG), (11, "a short item"), (12, "the fox sleeps")]
    assert got(contamination(docs_frame(spark, docs), items_frame(spark, items))) == brute(docs, items)
