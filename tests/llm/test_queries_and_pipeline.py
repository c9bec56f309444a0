"""The registered queries on the small tables, against their SQL; the pipeline stage by stage."""

import glob
import os

import duckdb
import pytest
from fixtures import SCHEMA, documents, frame

import corpus_pipeline
from fillwise.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs_and_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)
    assert got
    if name in ORACLES:
        want = duck.execute(ORACLES[name])
        at = [[d[0] for d in want.description].index(c) for c in columns]
        assert got == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=str)


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = frame(spark).select("doc_id", "text", "lang", "source", "n_chars")
    sizes = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == before.columns
            docs = spark.createDataFrame(docs.collect(), before.schema)
        sizes[name] = docs.count()
        if name == "near_duplicates":
            ids = [r.doc_id for r in docs.collect() if r.doc_id is not None]
            assert len(ids) == len(set(ids)) and not {2, 3, 11, 12} & set(ids)
        if name == "repeated_passages":
            assert all(r.n_chars == len(r.text) for r in docs.collect() if r.text is not None)
    assert sizes["encode"] == sizes["mix"] > 0


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_an_empty_table(spark, stage):
    empty = spark.createDataFrame([], SCHEMA).select("doc_id", "text", "lang", "source", "n_chars")
    assert stage(spark, empty, SF).count() == 0
    assert documents()


def test_near_duplicates_of_the_pipeline_take_five_words(spark):
    def changed(n, at, name):
        words = [f"{name}{i}" for i in range(n)]
        return " ".join(words), " ".join(f"new{i}" if i in at else w for i, w in enumerate(words))

    # four words: 69 of 85 shingles, five words: 66 of 86; and 106 of 126 by five words
    texts = [*changed(80, (20, 50), "a"), *changed(120, (30, 70), "b")]
    rows = [(i, t, "en", "x", len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()) == [0, 1, 2]
