"""Line dedup against brute force over all windows."""
import random
from collections import Counter

from llm_helpers import EDGE, docs_frame, small_documents

from sigshape.llm.line_dedup import LONG_WORDS, SHORT, WINDOW, dedup_lines
from sigshape.llm.queries import QUERIES


def brute(rows, window=WINDOW, long_words=LONG_WORDS):
    """rows: distinct (id, text); earlier = less id (null first), then hash order is
    never needed because the ids differ."""
    blanks = " \t\r\x0b\x0c"
    lines = {i: [(k, x.strip(blanks)) for k, x in enumerate((t or "").split("\n")) if x.strip(blanks)] for i, t in rows}
    order = sorted(lines, key=lambda i: (i is not None, i or 0))
    first, gone = {}, {i: set() for i in lines}
    for i in order:
        x = [s for _, s in lines[i]]
        spans = [(s, window) for s in range(len(x) - window + 1)]
        spans += [(s, 1) for s in range(len(x)) if len([w for w in x[s].replace("\t", " ").split(" ") if w]) >= long_words]
        for s, n in spans:
            place = first.setdefault((n, *x[s:s + n]), (i, s))
            if place == (i, s):
                continue
            j, q = place
            y = [v for _, v in lines[j]]
            a, b, c = s, q, s + n
            while a > 0 and b > 0 and x[a - 1] == y[b - 1]:
                a, b = a - 1, b - 1
            d = q + n
            while c < len(x) and d < len(y) and x[c] == y[d]:
                c, d = c + 1, d + 1
            gone[i].update(range(a, c))
    out = []
    for i, t in rows:
        numbers = sorted(lines[i][k][0] for k in gone[i])
        every = (t or "").split("\n")
        out.append((i, len(every) if t else 0, len(numbers), ",".join(map(str, numbers)),
                    "\n".join(x for k, x in enumerate(every) if k not in set(numbers))))
    return sorted(out, key=repr)


def got(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def test_planted_runs(spark):
    rng = random.Random(2)
    pool = [f"line {i}" for i in range(12)] + ["", "  ", "a " * 30, "b " * 26 + "end"]
    rows = [(i, "\n".join(rng.choice(pool) + rng.choice(["", " ", "\t", "\r"]) for _ in range(rng.randint(0, 40)))) for i in range(60)]
    assert got(dedup_lines(docs_frame(spark, rows))) == brute(rows)


def test_first_places_stay_and_runs_extend(spark):
    long = "w " * 30
    rows = [(1, f"head\n{long}\ntail\nx"), (2, f"y\nhead\n\n{long}\ntail\nz"), (3, "a\nb\nc\na\nb\nc\na\nb\nc"), (4, "q\n" * 9)]
    out = {r.doc_id: r for r in dedup_lines(docs_frame(spark, rows)).collect()}
    assert out[1].n_deleted == 0 and out[2].deleted == "1,3,4" and out[2].text == "y\n\nz"
    assert out[3].deleted == "3,4,5,6,7,8" and out[4].deleted == "1,2,3,4,5,6,7,8"


def test_edges(spark):
    out = got(dedup_lines(docs_frame(spark, EDGE)))
    assert len(out) == len(EDGE) and [r[0] for r in out].count(4) == 2
    assert got(dedup_lines(docs_frame(spark, []))) == []
    one = docs_frame(spark, [(1, "a\nb\nc"), (1, "a\nb\nc"), (2, "a\nb\nc")])          # repeated rows are one document
    assert sorted((r.doc_id, r.n_deleted) for r in dedup_lines(one).collect()) == [(1, 0), (1, 0), (2, 3)]


def test_a_line_in_every_document(spark):
    rows = [(i, f"{'hot ' * 30}\nown {i}") for i in range(200)]
    assert got(dedup_lines(docs_frame(spark, rows))) == brute(rows)


def test_small_table(spark):
    docs = small_documents(spark)
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert got(dedup_lines(docs)) == want
    assert sum(w[2] for w in want) > 0


def brute_short(rows, short):
    """Windows as in ``brute``, with those of the shorter runs; ids are distinct and not null."""
    lines = {i: [x for x in t.split("\n") if x] for i, t in rows}
    words = lambda x: len(x.split())
    places = Counter(x for y in lines.values() for x in y)
    first, gone = {}, {i: set() for i in lines}
    for i in sorted(lines):
        x = lines[i]
        spans = [(s, WINDOW) for s in range(len(x) - WINDOW + 1)]
        spans += [(s, 2) for s in range(len(x) - 1) if words(x[s]) + words(x[s + 1]) >= short.run_words]
        spans += [(s, 1) for s in range(len(x)) if words(x[s]) >= short.run_words
                  or words(x[s]) >= short.line_words and places[x[s]] >= short.often]
        for s, n in spans:
            j, q = first.setdefault((n, *x[s:s + n]), (i, s))
            if (j, q) == (i, s):
                continue
            y, a, b, c, d = lines[j], s, q, s + n, q + n
            while a > 0 and b > 0 and x[a - 1] == y[b - 1]:
                a, b = a - 1, b - 1
            while c < len(x) and d < len(y) and x[c] == y[d]:
                c, d = c + 1, d + 1
            gone[i].update(range(a, c))
    return {i: ",".join(map(str, sorted(g))) for i, g in gone.items()}


def test_short_runs(spark):
    rng = random.Random(3)
    pool = [" ".join([f"w{i}"] * (1 + i % 9)) for i in range(150)] + ["a rare note"] * 2 + ["a hot line"] * 9
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 9)))) for i in range(60)]
    want = brute_short(rows, SHORT)
    assert {r.doc_id: r.deleted for r in dedup_lines(docs_frame(spark, rows), short=SHORT).collect()} == want


def test_the_query_deletes_short_boilerplate(spark, tmp_path):
    notice = "Licensed under the Apache License, Version 2.0."
    rows = [(i, f"own {i}\n{notice}\nend {i}") for i in range(12)] + [(20, "a\none two three four\nfive six seven eight\nb"),
                                                                     (21, "c\none two three four\nfive six seven eight\nd"),
                                                                     (22, "e\none line of nine words that stands here twice\nf"),
                                                                     (23, "g\none line of nine words that stands here twice\nh")]
    docs_frame(spark, rows + rows[:1] * 9).write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: r.deleted for r in QUERIES["op1_line_dedup"](spark, str(tmp_path)).collect()}
    assert out == {0: "", **{i: "1" for i in range(1, 12)}, 20: "", 21: "1,2", 22: "", 23: "1"}
