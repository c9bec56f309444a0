"""Quality rules by MCD against plain counting, a plain version of the estimate and the true optimum."""

import itertools
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from fixtures import SCHEMA, documents, empty, frame, prose

from fillwise.llm import robust_outliers as ro

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute_counts(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup, lines = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
            lines += 1
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    n = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if n[x] > 1 for k in range(5)}
    return [len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text)), dup, len(covered), lines]


def texts():
    again = "one two three four five six seven eight nine ten\n"
    return [None, "", " \n\t", "a", "a\na\na", "x y\nx y \nx y", again * 3, again + "\n" + again, "a " * 20, "#*$ é|漢 <🙂>&%",
            "\n\nq\n\nq", "q\n", "b\n", prose(3, 30_000), "w1 w2 w3 w4 w5 w1 w2 w3 w4 w5 w6", "1 2 3 4 5 6 7 1 2 3 4 5 8", "\x0bz\x0cz\rz"]


def test_counts():
    assert ro.counts(pa.array(texts())).tolist() == [brute_counts(t) for t in texts()]
    long = pa.array(texts() + [prose(5, 300_000)] + texts(), pa.large_string())
    assert ro.counts(long).tolist() == [brute_counts(t) for t in long.to_pylist()]


def plain(x):
    """The estimate of one group by numpy, without bins for the concentration steps."""
    n, p = x.shape
    h = math.ceil((n + p + 1) / 2)
    floor = np.diag(np.square(ro.RESOLUTION))
    q = np.percentile(x, [25, 50, 75], axis=0)
    scale = np.maximum((q[2] - q[0]) / 1.349, ro.RESOLUTION)
    best = None
    for squash in (False, True):
        m = q[1]
        c = np.diag(scale**2) if not squash else np.cov(np.tanh((x - m) / scale).T, bias=True) / 0.394 * np.outer(scale, scale)
        c = c + floor
        for _ in range(50):
            d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
            near = x[np.argsort(d, kind="stable")[:h]]
            m, c = near.mean(0), np.cov(near.T, bias=True) * ro.widening(0.5) + floor
        if best is None or np.linalg.slogdet(c)[1] < best[0]:
            best = np.linalg.slogdet(c)[1], m, c
    _, m, c = best
    d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
    near = x[d <= ro.chi2_quantile(ro.WITHIN, p)]
    return near.mean(0), np.cov(near.T, bias=True) * ro.widening(ro.WITHIN) + floor


def vectors(rows):
    c = np.array(rows, float)
    return np.c_[np.log(c[:, 0]), np.log((c[:, 1] + 100) / (c[:, 0] + 20)), np.arcsin(np.sqrt(c[:, 2] / (c[:, 1] + 1))),
                 np.arcsin(np.sqrt(c[:, 3] / (c[:, 5] + 10))), np.arcsin(np.sqrt(c[:, 4] / (c[:, 0] + 50)))]


def corpus():
    """Two large groups, one small one; one document in five is junk, and copies of one junk text abound."""
    rng = np.random.default_rng(4)
    rows, words = [], [f"{'abcdefgh'[i % 8] * (2 + i % 7)}{i}" for i in range(500)]
    junk = " ".join(["||", "##$$", "%%"] * 30 + words[:40])
    for i in range(900):
        source = "small" if i % 45 == 0 else ["p", None][i % 2]
        n = int(np.exp(rng.normal(5, 0.7))) + 10
        t = " ".join(rng.choice(words, n))
        if i % 5 == 0:
            t = re.sub(" ", lambda m: " $## " if rng.random() < 0.6 else " ", t)
        rows.append((i, t, "en" if i % 3 else None, source))
    rows += [(1000 + i, junk, "en", "p") for i in range(900)]
    return [(i, t, lang, s, 0, 0.5, 7, 1) for i, t, lang, s in rows]


def test_verdicts_equal_a_plain_version(spark):
    rows = corpus()
    got = {r.row.doc_id: r for r in ro.judged(spark.createDataFrame(rows, SCHEMA), least=60).collect()}
    assert len(got) == len(rows)
    counted = {r[0]: brute_counts(r[1]) for r in rows}
    fit = [r for r in rows if counted[r[0]][0] >= 10 and 5 * counted[r[0]][4] <= counted[r[0]][0]]
    keys = [lambda r: (r[2], r[3]), lambda r: r[2], lambda r: None]
    est = []
    for key in keys:
        groups = {}
        for r in fit:
            groups.setdefault(key(r), set()).add(tuple(counted[r[0]]))
        est.append({k: plain(vectors(sorted(v))) for k, v in groups.items() if len(v) >= 60})
    assert ("en", "small") not in est[0] and ("en", "p") in est[0]
    differ = 0
    for r in rows:
        g = got[r[0]]
        assert [g[c] for c in ro.COUNTS] == counted[r[0]]
        failed = counted[r[0]][0] < 10 or 5 * counted[r[0]][4] > counted[r[0]][0]
        assert g.base_failed == failed
        if failed:
            assert not g.kept
            continue
        m, c = next(e[k(r)] for e, k in zip(est, keys) if k(r) in e)
        x = vectors([counted[r[0]]])[0] - m
        d = x @ np.linalg.inv(c) @ x
        assert abs(d - g.distance) <= 0.25 * d + 0.5
        differ += g.kept != (d <= ro.LIMIT)
    assert differ <= 3
    kept = [got[r[0]].kept for r in rows]
    assert not any(kept[900:]) and sum(kept[i] for i in range(0, 900, 5)) == 0
    assert sum(kept[i] for i in range(900) if i % 5) >= 0.99 * 720


def test_steps_reach_the_least_determinant_of_a_small_group():
    """On groups small enough to try every half, the concentration ends near the optimum."""
    rng = np.random.default_rng(3)
    x = np.r_[rng.normal(0, 1, (10, 2)), rng.normal(6, 0.1, (4, 2))]
    h = (14 + 3) // 2
    least = min(np.linalg.det(np.cov(x[list(s)].T, bias=True)) for s in itertools.combinations(range(14), h))
    m, c = np.median(x, 0), np.diag(x.std(0) ** 2)
    for _ in range(20):
        near = x[np.argsort(np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m))[:h]]
        m, c = near.mean(0), np.cov(near.T, bias=True)
    assert np.linalg.det(c) <= 3 * least


def test_chi_square():
    # fixed values: 0.5, 0.975 and 0.99 quantiles of 5 degrees of freedom, and 0.95 of one
    for p, k, want in [(0.5, 5, 4.35146), (0.975, 5, 12.8325), (0.99, 5, 15.0863), (0.95, 1, 3.84146)]:
        assert ro.chi2_quantile(p, k) == pytest.approx(want, rel=1e-5)


def test_awkward_tables(spark):
    got = {(r.row.doc_id, r.row.text): r for r in ro.judged(frame(spark), least=5).collect()}
    assert all([got[d[0], d[1]][c] for c in ro.COUNTS] == brute_counts(d[1]) for d in documents())
    assert ro.judged(frame(spark)).count() == len(documents())
    assert ro.judged(empty(spark)).count() == 0
    clash = frame(spark).selectExpr("doc_id", "text", "lang", "source", "1 as n_words", "2 as kept", "'x' as own", "3 as centre")
    assert ro.judged(clash).count() == len(documents())
