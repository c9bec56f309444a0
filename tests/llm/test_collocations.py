"""Collocations against plain Python counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from fixtures import SCHEMA, documents, empty, frame

from fillwise.llm import collocations

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(docs, least=10, longest=3, top=2000):
    count, total = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            for m in range(1, longest + 1):
                count.update((lang, tuple(w[i : i + m])) for i in range(len(w) - m + 1))
    found, longer = [], Counter()
    for (lang, p), a in count.items():
        if len(p) > 1 and a >= least:
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    longer[lang, p[i : i + m]] = max(longer[lang, p[i : i + m]], a)
    for (lang, p), a in count.items():
        if len(p) > 1 and a >= least and not (longer[lang, p] and 100 * longer[lang, p] >= 50 * a):
            cuts = [(10**6 * a * a // (count[lang, p[:k]] * count[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((lang, " ".join(p), a, count[lang, p[:k]], count[lang, p[k:]], total[lang], score))
    out = []
    for lang in total:
        mine = sorted((f for f in found if f[0] == lang), key=lambda f: (-f[6], -f[2], f[1].encode()))[:top]
        out += [(lang, i + 1, *f[1:]) for i, f in enumerate(mine)]
    return sorted(out)


def rows():
    rnd = random.Random(2)
    words = ["the", "of", "New", "york", "city", "é漢", "🙂", "a-b", "x" * 50, "und", "Ärger", "ÄRGER", "\x0b", "\x1c\x85"]
    weights = [30, 20, 8, 8, 6, 3, 3, 2, 2, 2, 1, 1, 1, 1]
    out = []
    for lang in ["en", "de", None, "und", "", "a b"]:
        for _ in range(30):
            w = rnd.choices(words, weights, k=rnd.randint(0, 80))
            out.append((rnd.choice([" ", "\t ", " "]).join(x + rnd.choice(["", "", "", ",", ".\n"]) for x in w), lang))
    out += [("a a a a a a a a a a a a a a", "en"), ("", "en"), (None, "en"), (" \t\n", None)]
    out += [("New York City never sleeps. new york city", "rep")] * 40 + [("long " * 20_000, "long")]
    return out


def got(spark, docs, **kw):
    df = spark.createDataFrame(docs, "text string, lang string").selectExpr("text", "lang", "1 as f", "2 as unit", "3 as N")
    return sorted(tuple(r[c] for c in COLUMNS) for r in collocations.collocations(df.repartition(5), **kw).collect())


def test_equals_brute_force(spark):
    assert got(spark, rows()) == brute(rows())


def test_few_ranks_bits_and_parts_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(collocations, "FAN", 2)
    assert got(spark, rows(), ranked=7, bits=1 << 10, top=9, least=6) == brute(rows(), least=6, top=9)


def test_phrases_of_four_words(spark):
    assert got(spark, rows(), longest=4, least=5) == brute(rows(), least=5, longest=4)


def test_awkward_tables(spark):
    docs = [(t, lang) for _, t, lang, *_ in documents()]
    assert sorted(tuple(r[c] for c in COLUMNS) for r in collocations.collocations(frame(spark), least=3).collect()) == brute(docs, least=3)
    assert collocations.collocations(empty(spark)).count() == 0
    none = spark.createDataFrame([(1, None, None, None, None, None, None, None)], SCHEMA)
    assert collocations.collocations(none).count() == 0


@pytest.mark.parametrize("sizes", [[3], [300, 5, 2000], [70_000, 100]])
def test_addresses_lead_back(sizes):
    lang = np.repeat(np.arange(len(sizes)), sizes)
    rank = np.concatenate([np.arange(n) for n in sizes])
    x = collocations.Ids({}, np.zeros(0, np.int64), np.zeros(0, np.int64), lang, rank, np.zeros(1, np.uint8))
    rng = np.random.default_rng(1)
    left = rng.integers(0, len(lang), 5000)
    right = np.searchsorted(lang, lang[left]) + rng.integers(0, np.array(sizes)[lang[left]])
    at = collocations.addresses(left, right, x, x)
    assert len(set(at.tolist())) == len(set(zip(left.tolist(), right.tolist())))
    back = collocations.located(at, x, x)
    assert (back[0] == left).all() and (back[1] == right).all()
    assert ((at & ((1 << collocations.LOCAL_BITS) - 1)) < [collocations._area(t) for t in (at >> collocations.LOCAL_BITS).tolist()]).all()


def test_encoded_rows_are_of_bounded_size(spark, monkeypatch):
    """Blocks of texts were one row each, which a page of the written table held by the hundred."""
    piece = "der hund und die katze "
    docs = [(f"{piece * 20}. " * 300, "de")] * 4 + [(piece * 5000, "de"), (None, "de"), ("", None), (" ,; ", "en")]
    df = spark.createDataFrame(docs, "text string, lang string")
    seen = []
    real = collocations.stored

    def stored(table):
        out = real(table)
        if table.columns == ["ids", "more"]:
            seen.extend(len(r.ids) // 4 for r in out.collect())
        return out
    monkeypatch.setattr(collocations, "stored", stored)
    assert sorted(map(tuple, collocations.collocations(df).select(COLUMNS).collect())) == brute(docs)
    assert sum(seen) == 4 * 300 * 101 + 25_001
    assert sorted(seen)[-1] == 25_001 and sorted(seen)[-2] <= collocations.ROW_WORDS + 101


def test_rows_are_cut_at_pieces_only():
    breaks = np.array([0, 3, 10_000, 40_000, 40_005, 50_000])
    seq = np.arange(60_000)
    parts = list(collocations._rows(seq, breaks))
    assert (np.concatenate(parts) == seq).all() and all(p[0] in breaks for p in parts)
    assert [p[0] for p in parts] == [0, 40_000, 50_000]
    assert list(collocations._rows(seq[:0], breaks[:0])) == []


def test_word_counts_come_in_bounded_batches():
    import pyarrow as pa
    text = " ".join(f"w{i}" for i in range(25_000))
    out = list(collocations._count_words(iter([pa.RecordBatch.from_arrays([pa.array([text]), pa.array(["en"])], ["text", "lang"])])))
    assert max(b.num_rows for b in out) <= 10_000 and sum(b.num_rows for b in out) == 25_000


def test_batch_size_of_the_session_is_left_as_it_was(spark):
    from fillwise.session import ARROW_BYTES
    before = spark.conf.get(ARROW_BYTES)
    spark.conf.set(ARROW_BYTES, "7m")
    try:
        collocations.count_phrases(spark.createDataFrame([("a b " * 20, "en")], "text string, lang string"))
        assert spark.conf.get(ARROW_BYTES) == "7m"
    finally:
        spark.conf.set(ARROW_BYTES, before)
