"""Packing: exact round trip of the ids, little padding, edge cases."""
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from llm_helpers import EDGE, docs_frame, small_documents

from sigshape.llm.packing import WINDOW, combinations, intervals, nnls, pack, plan, tokenizer_at
from sigshape.llm.queries import TOKENIZER, tokenizer_file


def plain_ids(text):
    from tokenizers import Tokenizer
    if not hasattr(plain_ids, "t"):
        plain_ids.t = Tokenizer.from_file(tokenizer_file(TOKENIZER))
        plain_ids.t.encode_special_tokens = True
    return plain_ids.t.encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, out, most_padding):
    ids = defaultdict(list)
    for i, t in rows:
        ids[i].append(plain_ids(t))
    want = Counter()
    for i, lists in ids.items():
        for x in lists:
            raw = np.array(x, "<u4").tobytes()
            for at in range(0, len(x), WINDOW):
                part = raw[4 * at:4 * (at + WINDOW)]
                want[(i, at, len(part) // 4, zlib.crc32(part), len(x))] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in out) == want
    sequences = defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append(r)
    assert sorted(sequences) == list(range(len(sequences)))
    padded = filled = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= WINDOW
        filled += at
        padded += at if at & (at - 1) == 0 else WINDOW
    assert padded - filled <= most_padding * padded + WINDOW


def test_edges(spark):
    check(EDGE, pack(docs_frame(spark, EDGE), tokenizer_file(TOKENIZER)).collect(), 0.2)
    assert pack(docs_frame(spark, []), tokenizer_file(TOKENIZER)).collect() == []


def test_small_table(spark):
    docs = small_documents(spark)
    check([(r.doc_id, r.text) for r in docs.collect()], pack(docs, tokenizer_file(TOKENIZER)).collect(), 0.02)


def test_latin_words_go_to_the_model_folded():
    """Every composed Latin letter, alone and within a word, has the ids of the whole tokenizer;
    letters that fold to more than letters, and other scripts, go through all of it."""
    from sigshape.llm.packing import _folded
    letters = [chr(c) for c in range(0x41, 0x300) if chr(c).isalpha()]
    words = [*letters, *(f"ab{c}é" for c in letters), "Érépaê", "ciónÑDOAR", "straße", "İstanbul", "ΣΑΣ", "Ünïcode,", "été.", "слово", "語"]
    tokenizer = tokenizer_at(tokenizer_file(TOKENIZER))
    for w, ids in zip(words, tokenizer.ids(words)):
        assert np.frombuffer(ids, "<u4").tolist() + [1] == plain_ids(w), w
    assert _folded("Érépaê") is not None and _folded("İstanbul") is None and _folded("слово") is None and _folded("a1") is None


def test_word_by_word_equals_whole_text():
    texts = ["It's, isn't. we'll 're x's, '", "A.B.C, d..", "é é, ́ á.", "a b c\x1cd\x85e",
             "  two  spaces\n\nlines\ttabs\r\n", "<|endoftext|> <|startoftext|>, x", "ΑΣ ΑΣ. İ, I", "123,456. 7.", "", "ß, ſ. K",
             "漢字, かな. 한국어", "🙂, a🙂. b"]
    got = list(tokenizer_at(tokenizer_file(TOKENIZER)).ids(texts))
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [plain_ids(t)[:-1] for t in texts]


def test_least_squares_against_its_conditions():
    rng = np.random.default_rng(0)
    for _ in range(5):
        columns = combinations(24, rng.random(25) < 0.8)
        b = rng.integers(0, 50, 25).astype(float)
        weight = np.arange(25) / 24
        x = nnls(columns, b, weight)
        a = np.zeros((25, len(columns)))
        for j, c in enumerate(columns):
            np.add.at(a[:, j], c, weight[c])
        b = b * weight
        grad = a.T @ (b - a @ x)
        assert (x >= 0).all() and (grad <= 1e-4).all() and np.abs(grad[x > 1e-9]).max(initial=0) < 1e-4


def test_combinations_fill_a_window():
    present = np.ones(13, bool)
    present[5] = False
    got = {tuple(c) for c in combinations(12, present)}
    assert got == {(a, b, 12 - a - b) for a in range(13) for b in range(a + 1) if 0 <= 12 - a - b <= b
                   and not {a, b, 12 - a - b} & {5}}


def test_plan_uses_the_histogram_up_and_wastes_little():
    rng = random.Random(3)
    histogram = {n: rng.randint(20, 200) for n in range(1, WINDOW)} | {WINDOW: 500}
    patterns = plan(histogram)
    used = Counter()
    for lengths, n in patterns:
        assert sum(k * length for length, k in lengths.items()) <= WINDOW
        for length, k in lengths.items():
            used[length] += k * n
    assert used == Counter(histogram)
    sequences = sum(n for _, n in patterns)
    tokens = sum(k * n for k, n in histogram.items())
    assert sequences * WINDOW < 1.01 * tokens
    places = intervals(patterns)
    for length, part in places.groupby("at_length"):
        assert part["lo"].iloc[0] == 0 and (part["lo"].iloc[1:].values == part["hi"].iloc[:-1].values).all()
        assert part["hi"].iloc[-1] == histogram[length]


def test_short_documents_only():
    patterns = plan({100: 1000, 3: 7})
    assert sum(n for _, n in patterns) == 50


def test_repeated_rows_fall_into_many_cells(spark, monkeypatch):
    import sigshape.llm.packing as m
    from pyspark.sql import functions as F
    monkeypatch.setattr(m, "CELL_ROWS", 5)
    rows = [(7, "the same few words")] * 300 + [(i, f"own {i}") for i in range(40)]
    seen, real = [], m.gapless_rank

    def spy(df, *a, salt, **kw):
        seen.extend(r["count"] for r in df.groupBy("length", F.pmod(F.xxhash64(*salt), a[1].cast("bigint")).alias("c")).count().collect())
        return real(df, *a, salt=salt, **kw)

    monkeypatch.setattr(m, "gapless_rank", spy)
    out = pack(docs_frame(spark, rows), tokenizer_file(TOKENIZER)).collect()
    check(rows, out, 1.0)
    assert max(seen) < 100
