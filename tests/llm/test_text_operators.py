"""BPE, suffix dedup, MinHash, mixing, language, quality and their brute-force versions."""

import base64
import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from fixtures import documents, empty, frame, prose
from pyspark.sql import functions as F

from fillwise.llm import bpe, langid, minhash, mixing, quality, suffix


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import public_tokenizers
    import tiktoken
    with open(public_tokenizers.path(bpe.VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library_on_every_row(spark, tiktoken_encoding):
    got = rows_of(bpe.encode_documents(frame(spark)), "doc_id", "n_tokens", "ids", "decoded")
    want = []
    for d in documents():
        ids = tiktoken_encoding.encode_ordinary(d[1] or "")
        want.append((d[0], len(ids), bytearray(np.array(ids, "<u4").tobytes()), bytearray((d[1] or "").encode())))
    assert got == sorted(want, key=str)
    assert bpe.encode_documents(empty(spark)).count() == 0


def test_bpe_on_random_strings(tiktoken_encoding):
    import public_tokenizers
    packer = bpe.Tokenizer(public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.PATTERN).packer()
    rnd = random.Random(4)
    for _ in range(3000):
        s = "".join(rnd.choice("aeithnsr onli'\n\t 09.,é\x1c\x85 ²漢́-") for _ in range(rnd.randint(0, 40)))
        ids = np.frombuffer(packer.encode(s), "<u4").tolist()
        assert ids == tiktoken_encoding.encode_ordinary(s), s
        assert packer.tokenizer.decode(packer.encode(s)) == s.encode()


def brute_suffix(docs, length=suffix.LENGTH):
    first = {}
    for i, t in ((d[0], (d[1] or "").encode()) for d in docs):
        if i is not None:
            for k in range(len(t) - length + 1):
                w = t[k : k + length]
                first[w] = min(first.get(w, i), i)
    out = []
    for d in docs:
        t = (d[1] or "").encode()
        mark = np.zeros(len(t) + 1, int)
        if d[0] is not None:
            for k in range(len(t) - length + 1):
                if first[t[k : k + length]] < d[0]:
                    mark[k] += 1
                    mark[k + length] -= 1
        gone = np.cumsum(mark)[:-1] > 0
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for k in range(len(t)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((d[0], len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_suffix_dedup_equals_brute_force(spark):
    df = frame(spark).drop("n_removed")
    got = suffix.remove_repeats(df)
    assert set(df.columns) <= set(got.columns)
    have = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got.collect()), key=str)
    assert have == brute_suffix(documents())
    assert suffix.remove_repeats(empty(spark).drop("n_removed")).count() == 0


def test_frequent_passages_take_the_window_route(spark, monkeypatch):
    monkeypatch.setattr(suffix, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(suffix, "HOT_BLOCKS", 10)
    passage = prose(77, 12)
    docs = [(i, prose(100 + i, 20) + " " + passage + " " + prose(300 + i, 15)) for i in range(120)]
    got = suffix.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string").repartition(4))
    have = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got.collect()), key=str)
    assert have == brute_suffix(docs)


def test_suffix_blocks_of_a_group_share_their_messages(spark, monkeypatch):
    """Messages are groups times shards, not blocks times shards; groups and pieces change no result."""
    kept = []
    monkeypatch.setattr(suffix, "stored", lambda df, store=suffix.stored: kept.append(store(df)) or kept[-1])
    monkeypatch.setattr(suffix, "BLOCK_BYTES", 2000)
    docs = [(i, prose(100 + i // 2, 20) + " " + prose(77, 12) + " " + prose(300 + i // 3, 15)) for i in range(120)]
    docs += [(None, docs[5][1]), (7, docs[9][1]), (200, ""), (201, None), (202, "a" * 2500), (203, "b" + "a" * 1200)]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)

    def result():
        del kept[:]
        got = suffix.remove_repeats(df).collect()
        return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got), key=str)

    want = brute_suffix(docs)
    assert result() == want
    assert kept[0].count() > 10 and kept[-1].count() <= 64
    monkeypatch.setattr(suffix, "GROUP_BYTES", 9000)
    monkeypatch.setattr(suffix, "TEXT_BYTES", 3000)
    assert result() == want
    assert kept[0].select("grp").distinct().count() > 2 and kept[-1].where("piece > 0").count() > 0
    monkeypatch.setattr(suffix, "HOT_BLOCKS", 5)
    assert result() == want


def test_suffix_array_and_prefixes():
    rnd = random.Random(3)
    for _ in range(200):
        a = np.array([rnd.randint(0, rnd.choice([1, 2, 5, 200])) for _ in range(rnd.randint(1, 60))], np.int16)
        assert suffix.suffix_array(a).tolist() == sorted(range(len(a)), key=lambda i: a.tolist()[i:])


def brute_sets(docs):
    out = []
    for d in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), d[1] or ""))
        out.append(frozenset(tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))) if w else frozenset())
    return out


def brute_near(docs):
    sets, parent = brute_sets(docs), {d[0]: d[0] for d in docs if d[0] is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        for j, t in enumerate(sets[:i]):
            a, b = docs[i][0], docs[j][0]
            if a is not None and b is not None and s and t and 100 * len(s & t) >= 80 * len(s | t):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return sorted(((d[0], len(s), None if d[0] is None else find(d[0]), d[0] is None or find(d[0]) == d[0])
                   for d, s in zip(docs, sets)), key=str)


def test_minhash_equals_brute_force(spark):
    got = minhash.near_duplicates(frame(spark))
    assert rows_of(got, "doc_id", "n_shingles", "component_id", "kept") == brute_near(documents())
    assert minhash.near_duplicates(empty(spark)).count() == 0


def test_minhash_with_a_large_group_of_copies(spark, monkeypatch):
    monkeypatch.setattr(minhash, "PART", 7)
    rnd = random.Random(8)
    words = prose(1, 60).split(" ")
    docs = []
    for i in range(90):  # pairs around the threshold, in buckets of several parts
        w = list(words)
        for _ in range(rnd.randint(0, 3)):
            w[rnd.randrange(len(w))] = f"w{rnd.randrange(9)}"
        docs.append((i, " ".join(w)))
    got = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    assert rows_of(got, "doc_id", "n_shingles", "component_id", "kept") == brute_near(docs)


def test_minhash_holds_the_set_of_a_repeated_row_once(spark, monkeypatch):
    held = []

    def cross_links(buckets, labelled, known, work=minhash.cross_links):
        held.extend((r.node, bytes(r.hashes)) for r in known.collect())
        return work(buckets, labelled, known)

    monkeypatch.setattr(minhash, "cross_links", cross_links)
    words = prose(21, 90).split(" ")
    near = " ".join([*words[:40], "changed", *words[41:]])
    docs = [*[(1, " ".join(words))] * 60, (2, near), (1, near.upper()), *[(3, prose(23, 40))] * 3, (4, prose(24, 40))]
    got = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(6))
    assert rows_of(got, "doc_id", "n_shingles", "component_id", "kept") == brute_near(docs)
    assert {i for i, _ in held} == {1} and len(held) == len(set(held)) == 2


def test_parts_of_a_bucket_follow_the_length_of_its_texts(spark):
    known = spark.createDataFrame([(i, minhash.PART_SHINGLES // 20) for i in range(200)], "node long, n long")
    buckets = known.select("node", F.lit(7).cast("long").alias("bucket"))
    dealt = minhash.dealt_members(buckets, spark.createDataFrame([], "node long, component long"), known)
    blocks = dealt.join(known, "node").groupBy("p", "q").agg(F.sum("n").alias("n")).collect()
    assert len(blocks) == 55 and max(r.n for r in blocks) < 4 * minhash.PART_SHINGLES


def test_pruning_keeps_what_reaches_the_threshold():
    for upto, least in minhash.BATCHES:
        assert 0 < least < 0.8 * upto


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    total, open_ = share * sum(sizes), set(range(len(sizes)))
    target = [0.0] * len(sizes)
    while open_:
        left = total - sum(target[i] for i in range(len(sizes)) if i not in open_)
        w = sum(weights[i % 3] for i in open_)
        over = [i for i in open_ if left * weights[i % 3] / w > cap * sizes[i]]
        if not over:
            for i in open_:
                target[i] = left * weights[i % 3] / w
            break
        for i in over:
            target[i] = cap * sizes[i]
            open_.discard(i)
    return target


def test_mixing_targets_and_quotas(spark):
    docs = frame(spark)
    got = mixing.mix(docs, block=4, shard_words=500).select("*", "_mix.*").collect()
    assert len(got) == len(documents())
    sizes = collections.Counter()
    for d in documents():
        sizes[d[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", d[1] or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = dict(zip(order, brute_targets([sizes[s] for s in order])))
    taken = collections.Counter()
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 2 * r.size
        assert r.taken == r.passes * r.size + sum(p["to"] - p["from"] for p in r.parts)
        taken[r.source] += r.taken
    for s in order:
        assert abs(taken[s] - want[s]) <= 0.02 * want[s] + 16, s
    again = mixing.mix(docs.repartition(5), block=4, shard_words=500)
    assert rows_of(again.select("doc_id", "_mix.size", "_mix.taken"), "doc_id", "size", "taken") == sorted(
        ((r.doc_id, r["size"], r.taken) for r in got), key=str)
    assert mixing.mix(empty(spark)).count() == 0


def test_apportionment_takes_the_highest_quotients(spark):
    rnd = random.Random(2)
    parties = [(g, i, rnd.choice([0, 1, 5, 50, 51, 400, 10_000])) for g in range(6) for i in range(rnd.randint(1, 12))]
    seats = {g: rnd.choice([0, 1, 7, 100, 3001]) for g in range(6)}
    df = spark.createDataFrame([(*p, seats[p[0]]) for p in parties], "g int, i int, w long, seats long")
    got = {(r.g, r.i): r.quota for r in mixing.apportion(df, ["g"], "w", "seats", "i").collect()}
    for g in range(6):
        mine = [(i, w) for h, i, w in parties if h == g]
        n = seats[g] if any(w for _, w in mine) else 0
        bids = sorted(((-w / (2 * k - 1), i, k) for i, w in mine if w for k in range(1, n + 1)))[:n]
        want = collections.Counter(i for _, i, _ in bids)
        assert all(got[g, i] == want[i] for i, _ in mine)


def test_quality_orders_held_out_documents(spark):
    rnd = random.Random(6)
    docs, labels = [], []
    for i in range(600):
        good = rnd.random() < 0.7
        text = prose(i, rnd.randint(5, 200))
        docs.append((i, text if good else " ".join(f"{w}###" for w in text.split(" "))))
        labels.append((i, int(good)))
    df = spark.createDataFrame([*docs, (None, None), (900, ""), (901, "x" * 50_000)], "doc_id long, text string")
    truth = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, quality int")
    model = quality.fit(df, truth)
    got = quality.scored(df, model).withColumn("held", quality.held_out("doc_id", 5, 0)).collect()
    assert len(got) == 603 and all(0 <= r.score <= 1 for r in got)
    held = [(r.score >= quality.THRESHOLD, dict(labels)[r.doc_id]) for r in got if r.held and r.doc_id in dict(labels)]
    assert np.mean([a == b for a, b in held]) > 0.95
    # without labels every text gets an even score; without texts there is no row
    blank = quality.fit(df, truth.limit(0))
    assert {r.score for r in quality.scored(df, blank).collect()} == {0.5}
    assert quality.scored(df.limit(0), model).count() == 0


def test_isotonic_is_ascending_and_keeps_means():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=500), rng.integers(0, 2, 500).astype(float)
    c, p = quality.isotonic(x, y)
    assert (np.diff(p) > 0).all() and (np.diff(c) > 0).all() and 0 <= p.min() <= p.max() <= 1


def test_weights_of_isotonic_count_as_rows():
    rng = np.random.default_rng(4)
    x, y = np.sort(rng.normal(size=60)), rng.integers(0, 2, 60).astype(float)
    n = rng.integers(1, 5, 60)
    c, p = quality.isotonic(x, y, n.astype(float))
    many_c, many_p = quality.isotonic(np.repeat(x, n), np.repeat(y, n))
    assert np.allclose(np.interp(x, c, p), np.interp(x, many_c, many_p), atol=1e-9)


def test_quality_fits_normal_equations_of_all_its_rows(spark):
    """Against a plain fit on every row: one id and text on a third of the rows weighs as often."""
    rnd = random.Random(9)
    rows = [(i, prose(i, rnd.randint(5, 80)) + (" ###" if i % 3 == 0 else "")) for i in range(200)]
    rows += [(7, rows[7][1])] * 100
    df = spark.createDataFrame(rows, "doc_id long, text string")
    truth = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(200)], "doc_id long, quality int")
    model = quality.fit(df, truth)
    import zlib
    mine = [(i, t) for i, t in rows if zlib.crc32(str(i).encode()) % 5]
    stats = quality.statistics(pa.array([t for _, t in mine]))
    y = np.array([float(i % 3 != 0) for i, _ in mine])
    scale = stats.std(0)
    plain = quality.Model(stats.mean(0), np.where(scale > 1e-9, scale, 1.0), None, None, None)
    assert np.allclose(model.mean, plain.mean) and np.allclose(model.scale, plain.scale, atol=1e-6)
    x = model.features(stats)
    a = x.T @ x
    beta = np.linalg.solve(a + quality.RIDGE * max(a[-1, -1], 1) / quality.FEATURES * np.eye(len(a)), x.T @ y)
    assert np.allclose(x @ model.beta, x @ beta, atol=1e-6)
    # a bound below the rows: a hot id brings no more than about that many numbers
    small = quality.fit(df, truth, train_rows=40)
    assert len(small.x) <= 80 and all(0 <= r.score <= 1 for r in quality.scored(df, small).collect())


def brute_log(word, p, net, pieces):
    """Sum over all segmentations, by recursion."""
    text = langid.START + word

    def total(i):
        if i == len(text):
            return np.ones(p.shape[1])
        out = langid.UNKNOWN * total(i + 1)
        for j in range(i + 1, len(text) + 1):
            k = pieces.get(text[i:j])
            if k is not None:
                out = out + p[k] * total(j)
        return out

    return np.log(total(0))


def test_forward_sums_every_segmentation():
    import public_tokenizers
    net = langid.lattice(public_tokenizers.path(langid.VOCABULARY))
    pieces = {w: net.trie.get(w) for w in net.trie.keys()}
    rng = np.random.default_rng(0)
    p = np.vstack([rng.dirichlet(np.ones(net.size), 3).T, np.full((1, 3), langid.UNKNOWN)])
    words = ["the", "straße", "漢字", "a", "unbelievable"]
    assert np.allclose(net.forward(words, p), [brute_log(w, p, net, pieces) for w in words])
    # expected uses: every segmentation covers the word once
    use = net.expected(words, np.ones((5, 3)), p)
    assert np.allclose((use * net.length[:, None]).sum(0), sum(len(w) + 1 for w in words))


def test_words_of_any_length_are_summed_whole():
    import public_tokenizers
    net = langid.lattice(public_tokenizers.path(langid.VOCABULARY))
    pieces = {w: net.trie.get(w) for w in net.trie.keys()}
    most = max(map(len, pieces))
    rng = np.random.default_rng(2)
    # the second language gives most pieces next to nothing, so its sum leaves a double's range soon
    p = np.vstack([np.stack([rng.dirichlet(np.ones(net.size)), rng.dirichlet(np.full(net.size, 0.01)) + 1e-12], 1), np.full((1, 2), langid.UNKNOWN)])

    def by_logs(word):
        text = langid.START + word
        total = np.full((len(text) + 1, 2), -np.inf)
        total[0] = 0
        for i in range(len(text)):
            total[i + 1] = np.logaddexp(total[i + 1], total[i] + np.log(langid.UNKNOWN))
            for j in range(i + 1, min(i + most, len(text)) + 1):
                k = pieces.get(text[i:j])
                if k is not None:
                    total[j] = np.logaddexp(total[j], total[i] + np.log(p[k]))
        return total[-1]

    letters = "abcdefghijklmnopqrstuvwxyzäß漢字的是不了人我在有他这"
    words = ["the", "a" * 5000, "".join(rng.choice(list(letters), 5000)), "x" * langid.PLAIN_CHARS, "x" * (langid.PLAIN_CHARS + 1), "haus" * 40]
    assert langid.words_of(" ".join(words)) == words
    assert np.allclose(net.forward(words, p), [by_logs(w) for w in words], rtol=1e-10)
    use = net.expected(words, np.full((len(words), 2), 2.0), p)
    assert np.allclose((use * net.length[:, None]).sum(0), 2.0 * sum(len(w) + 1 for w in words))
    # both ways give the same where both can
    first, size, a, b, piece = net.edges(words[:1] + words[3:4])
    for back in (False, True):
        plain, _ = net._sweep(first, size, a, b, piece, p, back)
        value, power = net._scaled(first, size, a, b, piece, p, back)
        assert np.allclose(np.ldexp(value, power.astype(np.int32)), plain, rtol=1e-12, atol=0)


def test_language_of_awkward_rows(spark):
    rows = [(i, prose(i, 60, ["the", "and", "with", "that", "house"]) if i % 2 else prose(i, 60, ["der", "und", "mit", "dass", "haus"]),
             "en" if i % 2 else "de") for i in range(80)]
    extra = [(100, None, "en"), (101, "", "en"), (102, "123 ²½ --", "de"), (103, "the house and that", None), (None, "der und mit", "de")]
    df = spark.createDataFrame([*rows, *extra], "doc_id long, text string, lang string")
    model = langid.fit(df.where(~langid.held_out("doc_id", 4, 2)))
    got = {(r.doc_id, r.text): (r.lang_pred, r.score) for r in langid.identified(df.drop("lang"), model).collect()}
    assert all(got[i, t][0] == lang for i, t, lang in rows)
    assert got[100, None] == got[101, ""] == got[102, "123 ²½ --"] == (langid.UND, 0.0)
    assert got[103, "the house and that"][0] == "en" and got[None, "der und mit"][0] == "de"
    nothing = langid.fit(df.limit(0))
    assert {r.lang_pred for r in langid.identified(df.drop("lang"), nothing).collect()} == {langid.UND}
