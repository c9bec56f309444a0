"""Sessions that have shipped nothing yet, clashing columns, repeated rows, wild markup."""

import os
import subprocess
import sys
import textwrap
import time

import numpy as np
import pytest
from fixtures import frame
from pyspark.sql import functions as F

import corpus_pipeline
from fillwise.llm import ann, html_extract, mixing, suffix

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"

FRESH = {
    "quotes": "quotes.link(spark.createDataFrame([(1, 0, 'user', 'a b'), (1, 1, 'user', '> a b')], 'conv_id long, turn long, role string, text string'))",
    "ann": "ann.search(spark.createDataFrame([(i, [float(i), 1.0]) for i in range(50)], 'vec_id long, embedding array<double>'), F.col('vec_id') < 2)",
    "quality": "quality.scored(docs, quality.fit(docs, spark.createDataFrame([(1, 1), (2, 0)], 'doc_id long, quality int')))",
    "langid": "langid.identified(docs, langid.fit(docs))",
    "suffix": "suffix.remove_repeats(docs)",
    "minhash": "minhash.near_duplicates(docs)",
    "embed_dedup": "embed_dedup.near_duplicates(spark.createDataFrame([(1, [1.0, 2.0], 'a')], 'vec_id long, embedding array<double>, label string'))",
    "turn_repair": "turn_repair.repair(spark.createDataFrame([(1, 0, 'user', 'a')], 'conv_id long, turn long, role string, text string')).summary",
    "collocations": "collocations.collocations(docs, least=1)",
    "robust_outliers": "robust_outliers.judged(docs)",
}


def test_every_module_ships_its_code(tmp_path):
    """From another folder, in a new session for each module, called first of all."""
    code = textwrap.dedent(f"""
        import sys
        sys.path.append({ROOT!r})
        from pyspark.sql import functions as F
        import fillwise.llm as _
        from fillwise.llm import ann, collocations, embed_dedup, langid, minhash, quality, quotes, robust_outliers, suffix, turn_repair
        from fillwise.session import build_session
        for name, call in {FRESH!r}.items():
            spark = build_session(master="local[2]", shuffle_partitions=2)
            docs = spark.createDataFrame([(i, "word " * 9 + str(i), "en", "s") for i in range(4)], "doc_id long, text string, lang string, source string")
            print(name, eval(call).count(), flush=True)
            spark.stop()
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=500)
    assert [x.split()[0] for x in done.stdout.splitlines() if x] == list(FRESH), done.stderr[-3000:]


CLASHING = ["target", "words", "idx", "shards", "_size", "kept", "n_bytes", "taken", "WORDS", "node", "_mix", "_row", "_key", "size"]


def clashing(spark):
    docs = frame(spark).select("doc_id", "text", "lang", "source", "n_chars")
    # names that differ in case only can't stand in one Parquet table
    names = [c for c in CLASHING if c != "WORDS"]
    return docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(names)])


@pytest.mark.parametrize("name", ["target", "words", "WORDS", "idx", "shards", "_size", "source_size", "seats"])
def test_mix_beside_any_column(spark, name):
    docs = frame(spark).select("doc_id", "text", "source")
    plain = {(r.doc_id, r.text, r.source, r._mix.taken) for r in mixing.mix(docs, tie=F.xxhash64("text")).collect()}
    more = mixing.mix(docs.withColumn(name, F.lit("x")), tie=F.xxhash64("text"))
    assert more.columns == ["doc_id", "text", "source", name, "_mix"]
    assert {(r.doc_id, r.text, r.source, r._mix.taken) for r in more.collect()} == plain


def test_suffix_replaces_columns_of_its_names(spark):
    docs = frame(spark).select("doc_id", "text")
    got = suffix.remove_repeats(docs.withColumns({"kept": F.lit(1), "N_Bytes": F.lit(2)}))
    assert got.columns == suffix.remove_repeats(docs).columns and got.count() == docs.count()


def test_stages_beside_any_column(spark):
    docs = clashing(spark)
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == before.columns
            docs = spark.createDataFrame(docs.collect(), before.schema)
        assert docs.count()


def test_repeated_query_rows_have_one_list(spark):
    rng = np.random.default_rng(1)
    x = [(i, [float(v) for v in rng.normal(size=6)]) for i in range(120)]
    rows = x + [x[100]] * 3 + [x[7]] * 20 + [(0, [9.0] * 6)]
    got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 100 == 0)
    lists = {}
    for r in got.orderBy("query_id", "rank").collect():
        lists.setdefault(r.query_id, []).append((r.rank, r.vec_id, round(r.score, 6)))
    f = {}
    for i, v in rows:
        f.setdefault(i, []).append(np.array(v, np.float32).astype(float))
    for q in (0, 100):
        near = sorted((min(np.linalg.norm(a - b) for a in f[q] for b in f[i]), i) for i in f if i != q)[:10]
        assert lists[q] == [(k + 1, i, round(d, 6)) for k, (d, i) in enumerate(near)]


@pytest.mark.parametrize("page", ["<a " * 350_000, "<div>" * 200_000, "<a " * 300_000 + '">"', '<a "' * 250_000 + ">", "<div>" * 100_000 + "</x>" * 200_000,
                                  "<script>" + "</script " * 100_000, "<head>" * 150_000, "<p><div>" + "<h1>x" * 50_000, "</a \"'" * 150_000])
def test_wild_markup_takes_seconds(page):
    began = time.time()
    html_extract.main_text(page, html_extract.PRIOR)
    assert time.time() - began < 20


def test_tags_of_a_page():
    tags = html_extract.Tags("""a<b c='>'>d</b ><!-- <x> --><y "q><!z>< n</ m><p""")
    found, at = [], 0
    while (t := tags.next(at)) is not None:
        found.append((t[2], t[3], t[4]))
        at = t[1]
    assert found == [("", "b", " c='>'"), ("/", "b", " "), ("", None, ""), ("", None, ""), ("", None, "")]


