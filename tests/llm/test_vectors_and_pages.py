"""Nearest neighbours, embedding near-duplicates, quotation links, main text, components."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from fillwise.llm import ann, embed_dedup, html_extract, quotes
from fillwise.llm.components import components


def vectors(seed=1, n=700, d=24):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)).astype(np.float32)
    x[50:90] = x[50] + 0.05 * rng.normal(size=(40, d)).astype(np.float32)  # a near-copy group
    x[100:130] = x[100]  # equal ones
    x[140:150] = 3 * x[140]  # the same direction
    x[140] = x[141] / 3
    rows = [(i, v.tolist(), int(i % 3) if not 40 <= i < 200 else 1, "extra") for i, v in enumerate(x)]
    nan, inf = float("nan"), float("inf")
    odd = [(900, None, 1), (901, [], 1), (902, [0.0] * d, 1), (903, [nan] + [1.0] * (d - 1), 1), (904, [inf] * d, 1),
           (905, [None] + [1.0] * (d - 1), 1), (906, x[60].tolist(), None), (None, x[60].tolist(), 1), (907, [1.0, 2.0], 1), (908, [1.0, 2.0], 1)]
    return rows + [(*o, "extra") for o in odd]


SCHEMA = "vec_id long, embedding array<float>, label int, node string"


def usable(v):
    return v and all(c is not None and np.isfinite(c) for c in v) and any(v)


@pytest.mark.parametrize("part, leaf", [(3000, 256), (9, 256), (3000, 6)])
def test_embedding_links_equal_brute_force(spark, monkeypatch, part, leaf):
    monkeypatch.setattr(embed_dedup, "PART", part)
    monkeypatch.setattr(embed_dedup, "LEAF", leaf)
    rows = vectors()
    got = sorted((tuple(r) for r in embed_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    links, parent = {i: 0 for i, *_ in rows}, {i: i for i, *_ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    good = [(i, np.array(v, np.float64), y) for i, v, y, _ in rows if i is not None and y is not None and usable(v)]
    for (i, u, a), (j, v, b) in itertools.combinations(good, 2):
        if a == b and len(u) == len(v) and u @ v >= 0.98 * np.sqrt((u @ u) * (v @ v)):
            links[i] += 1
            links[j] += 1
            x, y = find(i), find(j)
            if x != y:
                parent[max(x, y)] = min(x, y)
    want = [(i, links[i], find(i), find(i) == i) for i, *_ in rows if i is not None] + [(None, 0, None, True)]
    assert got == sorted(want, key=str)
    assert embed_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_blocks_never_miss_a_pair():
    rng = np.random.default_rng(3)
    u = rng.normal(size=(400, 64))
    v = u + 0.16 * rng.normal(size=u.shape)
    cos = (u * v).sum(1) / np.sqrt((u**2).sum(1) * (v**2).sum(1))
    spans, share = embed_dedup.shares(64, 0.98)
    d = (embed_dedup.rotated(u) - embed_dedup.rotated(v)) ** 2
    found = np.any([d[:, s].sum(1) <= w for s, w in zip(spans, share)], axis=0)
    assert (cos >= 0.98).any() and found[cos >= 0.98].all()


def test_cells_of_a_block_meet_every_near_pair_once():
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(700, 8)), np.repeat(rng.normal(size=(3, 8)), 60, 0)]) * 0.125
    tree = embed_dedup.planes(x[::2])
    share = 0.005
    for depth in (0, 3, 20):
        row, cell, home = embed_dedup.cells(x, tree, np.full(len(x), depth), share)
        own = np.zeros(len(x), np.int64)
        own[row[home]] = cell[home]
        assert home.sum() == len(x) and len(set(zip(row.tolist(), cell.tolist()))) == len(row)
        looks = set(zip(row[~home].tolist(), cell[~home].tolist()))
        near = np.argwhere(np.triu(((x[:, None] - x[None]) ** 2).sum(2) <= share, 1))
        assert len(near) > 5000
        for u, v in near.tolist():
            assert (own[u] == own[v]) + ((u, own[v]) in looks) + ((v, own[u]) in looks) == 1
    assert embed_dedup.cells(x[:0], tree, np.zeros(0, int), share)[0].size == 0
    assert (embed_dedup.planes(x[:0])[0] == -1).all() and (embed_dedup.planes(np.ones((500, 8)))[0] == -1).all()


def test_compared_share_falls_with_the_rows():
    share = []
    for n in (2000, 8000):
        z = embed_dedup.rotated(np.random.default_rng(1).normal(size=(n, 64)))
        depth, met = int(np.ceil(np.log2(n / embed_dedup.LEAF))), 0
        for span, w in zip(*embed_dedup.shares(64, 0.98)):
            _, cell, home = embed_dedup.cells(z[:, span], embed_dedup.planes(z[:, span]), np.full(n, depth), w)
            _, at = np.unique(cell, return_inverse=True)
            own, every = np.bincount(at, home), np.bincount(at)
            met += (own * (own - 1) / 2 + own * (every - own)).sum()
        share.append(met / (n * (n - 1) / 2))
    assert share[1] < 0.6 * share[0]


def test_nearest_neighbours_recall_and_order(spark):
    rows = vectors(5, 1500)
    df = spark.createDataFrame(rows, SCHEMA)
    got = ann.search(df, F.col("vec_id") % 20 == 0).collect()
    good = [(i, np.array(v, np.float32).astype(np.float64)) for i, v, *_ in rows if i is not None and usable(v) and len(v) == 24]
    ids, x = np.array([i for i, _ in good]), np.array([v for _, v in good])
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    assert set(by) == {i for i in ids.tolist() if i % 20 == 0}
    hit = total = 0
    for q, found in by.items():
        found.sort(key=lambda r: r.rank)
        d = np.sqrt(((x - x[ids.tolist().index(q)]) ** 2).sum(1))
        exact = dict(zip(ids.tolist(), d.tolist()))
        assert [r.rank for r in found] == list(range(1, 11)) and q not in [r.vec_id for r in found]
        assert all(r.score == exact[r.vec_id] for r in found)
        assert [(r.score, r.vec_id) for r in found] == sorted((r.score, r.vec_id) for r in found)
        best = [i for _, i in sorted((s, i) for i, s in exact.items() if i != q)[:10]]
        hit, total = hit + len(set(best) & {r.vec_id for r in found}), total + 10
    assert hit / total >= 0.9
    assert ann.search(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0).count() == 0
    few = spark.createDataFrame(rows[:4], SCHEMA)
    assert few.count() == 4 and ann.search(few, F.col("vec_id") == 0).count() == 3


def test_parts_are_balanced():
    x = np.random.default_rng(2).normal(size=(640, 8))
    near = ann.nearest(x, x, 5, skip=np.arange(640))
    part = ann.balanced_parts(near, 8)
    assert np.bincount(part).tolist() == [80] * 8
    cut = (part[np.repeat(np.arange(640), 5)] != part[near.ravel()]).mean()
    assert cut < 0.75  # a random split cuts 7/8


def test_components_of_random_graphs(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)] + [(2000, i) for i in range(2001, 2060)]
    got = dict(tuple(r) for r in components(spark.createDataFrame([*edges, (5, 5), (None, 3)], "a long, b long")).collect())
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    linked = {v for a, b in edges if a != b for v in (a, b)}
    assert got == {v: find(v) for v in linked}


def test_quotations_are_linked_and_ordered(spark):
    rows = [(1, 0, "user", "Hello there.\nSecond line of mine."), (1, 1, "assistant", "A new answer."),
            (1, 2, "user", "On Monday, X wrote:\n> hello   THERE.\n> Second line of mine.\nI agree."),
            (1, 3, "assistant", "> I agree.\n>> Hello there.\nMe too"), (1, 4, None, None), (1, 5, "u", "> nowhere\nx"), (1, 6, "u", ""),
            (None, 1, "u", "> Hello there."), (1, None, "u", "> Hello there."), (2, 0, "u", "Hello there."), (1, 1, "assistant", "A new answer.")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn int, role string, text string, thread string")
    got = {(r.conv_id, r.turn): r for r in quotes.link(df).collect()}
    assert quotes.link(df).count() == len(rows)
    assert (got[1, 2].text, got[1, 2].parent_turn, got[1, 2].thread, got[1, 2].depth) == ("I agree.", 0, 0, 1)
    assert (got[1, 3].text, got[1, 3].parent_turn, got[1, 3].thread, got[1, 3].depth) == ("Me too", 2, 0, 2)
    assert (got[1, 3].n_quotes, got[1, 3].n_linked) == (2, 2)
    assert (got[1, 5].parent_turn, got[1, 5].thread, got[1, 5].n_quotes, got[1, 5].n_linked) == (None, 5, 1, 0)
    assert got[None, 1].parent_turn is None and got[1, None].thread is None and got[1, 4].text == ""
    assert quotes.link(df.limit(0)).count() == 0


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header class="site"><h1>My Site</h1></header>
<div id="cookie-notice">We use cookies &amp; such</div><div class="menu"><a href=x>Home</a> <a href=y>About</a></div>
<main><article><header><h1>Real  head</h1></header><p>First para with <a href=z>link</a> &nbsp;inside.</p>
<div class="advert">Buy now</div><p>Second &lt;para&gt;.<aside>See also this</aside><p>Third<br>line
<form><label>Name</label><input><button>Go</button></form><script>var p = "</p>";</script>
<section class="comments"><article><p>A comment, long enough to look like text, with commas, and ends with a stop.</p></article></section>
</article></main><footer>&copy; me</footer>"""


def test_main_text_of_pages(spark):
    rows = [(1, "u", PAGE, "t"), (2, "u", None, "t"), (3, "u", "", "t"), (4, None, "plain words, no markup at all.", "t"),
            (5, "u", "<p>unclosed <b>bold <div", "t"), (1, "u", PAGE, "t"), (6, "u", "<article><p>" + "word " * 40_000 + "</article>", "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, label string")
    got = html_extract.extracted(df, html_extract.fit(df)).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == len(rows)
    assert by[1].text == "Real head\nFirst para with link inside.\nSecond <para>.\nThird line"
    assert by[2].text == by[3].text == "" and by[6].n_chars == 40_000 * 5 - 1
    assert html_extract.extracted(df.limit(0), html_extract.PRIOR).count() == 0


STORY = "".join(f"<p>Sentence {i} of the story is long enough to be read, and it ends with a stop.</p>" for i in range(6))


@pytest.mark.parametrize("wrap", [
    '<body class="has-sidebar"><article>{}</article></body>', '<body class="comments"><main>{}</main></body>',
    '<div class="content no-sidebar">{}</div>', '<article class="post comments-open category-social">{}</article>',
    '<form id="form1" class="page"><div id="content">{}</div></form>', '<form id="form1"><div>{}</div></form>',
    '<div class="sidebar"><article>{}</article></div>', '<div class="widget"><div>{}</div></div>'])
def test_names_around_a_page_do_not_hide_it(wrap):
    page = f'<nav><a href=x>Home</a></nav>{wrap.format(STORY)}<div class="comments"><article><p>A comment.</p></article></div>'
    for weights in (html_extract.PRIOR, html_extract.PRIOR + np.eye(9)[2] * -3):
        assert html_extract.main_text(page, weights) == "\n".join(re.findall("<p>(.*?)</p>", STORY))


def test_a_long_text_can_outvote_its_name():
    block = html_extract.Block("word " * 400 + "end.", (1,), html_extract.LOOSE, "p")
    short = html_extract.Block("Buy now", (1,), html_extract.LOOSE, "p")
    cost = html_extract.measured([block, short]) @ html_extract.PRIOR
    assert cost[0] > cost[1] + 2


def test_articles_beside_the_article_stay_apart():
    page = f'<article>{STORY}</article><div class="sidebar"><article><p>Another story, in short.</p></article></div>'
    assert html_extract.main_text(page, html_extract.PRIOR) == "\n".join(re.findall("<p>(.*?)</p>", STORY))


def test_cut_is_minimal():
    rnd = random.Random(5)
    for _ in range(200):
        n = rnd.randint(1, 9)
        cost = [rnd.uniform(-2, 2) for _ in range(n)]
        edges = [(i, j, rnd.uniform(0, 2)) for i in range(n) for j in range(i) if rnd.random() < 0.4]

        def energy(label):
            return (sum(max(c, 0) if not k else max(-c, 0) for c, k in zip(cost, label))
                    + sum(w for i, j, w in edges if label[i] != label[j]))

        best = min(energy(x) for x in itertools.product([False, True], repeat=n))
        assert energy(html_extract.min_cut(cost, edges)) == pytest.approx(best)
