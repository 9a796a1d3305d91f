"""The pipeline equals its operators applied one after another; queries match their SQL."""
import duckdb
import pytest

import corpus_pipeline
from llm_helpers import SF_SMALL, small_documents
from sigshape.llm.decontam import contamination
from sigshape.llm.exact_dedup import exact_groups
from sigshape.llm.oracle import ORACLE
from sigshape.llm.packing import pack
from sigshape.llm.quality import score_quality
from sigshape.llm.queries import QUERIES, TOKENIZER, tokenizer_file
from sigshape.llm.simhash import near_duplicates


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_stages_equal_the_operators(spark):
    docs = small_documents(spark)
    labels, items = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("labels", "benchmark"))
    state = docs

    def only(ids):
        return docs.where(docs["doc_id"].isin([r[0] for r in ids.collect()]))
    want = {
        "quality": lambda d: only(score_quality(d, labels).where("predicted = 1").select("doc_id")),
        "exact_dedup": lambda d: only(exact_groups(d).where("kept").select("doc_id")),
        "near_dedup": lambda d: only(near_duplicates(d).where("doc_id = component_id").select("doc_id")),
        "decontamination": lambda d: only(contamination(d, items).where("not contaminated").select("doc_id")),
    }
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, state, SF_SMALL)
        assert out.columns == docs.columns
        plain = want[name](state)
        assert rows(out) == rows(plain), name
        state = plain
        sizes.append(state.count())
    assert sizes == sorted(sizes, reverse=True) and 0 < sizes[-1] < sizes[0]
    assert rows(corpus_pipeline.run(spark, SF_SMALL)) == rows(pack(state, tokenizer_file(TOKENIZER)))


def test_stages_take_empty_and_repeated_rows(spark):
    docs = small_documents(spark)
    for some in (docs.limit(0), docs.limit(40).unionByName(docs.limit(40))):
        state = some
        for _, stage in corpus_pipeline.STAGES:
            state = stage(spark, state, SF_SMALL)
        got = state.collect()
        assert len({r.doc_id for r in got if r.start == 0}) == sum(r.start == 0 for r in got)


SPARK_TO_DUCKDB = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN", "double": "DOUBLE"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = QUERIES[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    rel = con.sql(ORACLE[name])
    types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert {c: SPARK_TO_DUCKDB[t] for c, t in df.dtypes} == types
    res = con.execute(ORACLE[name])
    names = [d[0] for d in res.description]
    want = sorted((tuple(r[names.index(c)] for c in cols) for r in res.fetchall()), key=repr)
    assert rows(df.select(*cols)) == want
