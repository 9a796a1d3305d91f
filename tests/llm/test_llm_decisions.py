"""Decisions hold for the row they were made for: ids that are null, or stand for several texts."""
import pytest
from llm_helpers import docs_frame

from sigshape.llm.decontam import drop_contaminated
from sigshape.llm.exact_dedup import drop_copies
from sigshape.llm.simhash import drop_near_copies

PASSAGE = "one two three four five six seven eight nine ten eleven"


def kept(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


@pytest.mark.parametrize("i", [None, 7])
def test_the_contaminated_text_of_an_id_goes(spark, i):
    items = spark.createDataFrame([("a", PASSAGE)], "item_id string, text string")
    rows = [(i, "clean"), (i, "clean"), (i, f"a longer text with {PASSAGE} in it"), (8, "other")]
    assert kept(drop_contaminated(docs_frame(spark, rows), items)) == sorted([(i, "clean"), (i, "clean"), (8, "other")], key=repr)


@pytest.mark.parametrize("i", [None, 7])
def test_one_of_each_content_stays_under_one_id(spark, i):
    rows = [(i, "a long text"), (i, "a long text"), (i, "b"), (i, "a  longtext"), (9, "b")]
    got = kept(drop_copies(docs_frame(spark, rows)))
    assert len(got) == 2 and {t.replace(" ", "") for _, t in got} == {"alongtext", "b"}
    assert all(r in rows for r in got) and [x for x, t in got if t == "b"] == [9 if i is None else 7]


@pytest.mark.parametrize("i", [None, 7])
def test_unlike_texts_of_one_id_all_stay(spark, i):
    texts = [" ".join(f"{w}{k}" for k in range(40)) for w in ("x", "y", "z")]
    rows = [(i, t) for t in texts] + [(i, texts[0]), (i, texts[1].upper())]
    got = kept(drop_near_copies(docs_frame(spark, rows)))
    assert sorted(t.lower() for _, t in got) == texts


@pytest.mark.parametrize("most", [10**6, 0])
def test_rows_go_and_repeats_are_folded_by_either_join(spark, monkeypatch, most):
    import sigshape.llm.decisions as m
    from pyspark.sql import functions as F
    monkeypatch.setattr(m, "MARKS", most)
    rows = [(1, "a"), (1, "a"), (1, "b"), (None, "a"), (None, None), (None, ""), (2, "c"), (3, "c"), (3, "c"), (3, "c")]
    docs = docs_frame(spark, rows)
    dropped = docs.where("doc_id = 2 or (doc_id = 1 and text = 'b')").select("doc_id", m.text_key("text").alias("key"))
    assert kept(m.drop_rows(docs, dropped)) == sorted([r for r in rows if r not in ((1, "b"), (2, "c"))], key=repr)
    once = kept(m.drop_rows(docs, dropped, once=True))
    assert sorted((repr(i), t or "") for i, t in once) == [("1", "a"), ("3", "c"), ("None", ""), ("None", "a")]
    assert m.drop_rows(docs, dropped, once=True).schema == docs.schema
    none = dropped.where(F.lit(False))
    assert kept(m.drop_rows(docs, none)) == sorted(rows, key=repr) and kept(m.drop_rows(docs.where(F.lit(False)), dropped, once=True)) == []
