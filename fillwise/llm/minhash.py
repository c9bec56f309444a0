"""MinHash near-duplicates with sequential Bayesian verification.

A document's set is its distinct shingles of ``shingle`` words, ``SHINGLE`` unless the caller
says otherwise (A-Z lower-cased, words are runs of non-space bytes), as 64-bit hashes; a shorter text is one shingle. Equal sets form a
class, named by its smallest doc_id; only one row a class goes on. Signatures of ``BANDS`` x
``ROWS`` minima are banded; each class meets a few centres of its buckets.
Candidate pairs compare their signatures batch by batch: after each batch the posterior
probability (uniform prior) that the similarity reaches the threshold is bounded, and a pair
below ``MISS`` is dropped. Survivors are verified on the full sets. Where a bucket's members
are still in different components after that, they are compared all with all by the same
batches and verified on their sets, so no link is left to the choice of centres. Those pairs
never leave the task: it has the members' signatures and sets, and returns links only.

Work per hot bucket: the centres take a min-aggregation and a join that Spark may split; the
members are dealt in blocks (bucket, part, part), whose parts are bounded by members and by
shingles. A set is stored once a node, however many rows repeat the doc_id and its text.

Rows: null or empty texts have an empty set, size 0, and link with nothing. A null doc_id
takes no part (its component is null, it is kept). Rows that repeat a doc_id are one
document that links where any of its texts does. The threshold is on exact counts:
100 * intersection >= ``PERCENT`` * union. Columns other than the key and the text may have
any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillwise.llm import textblocks
from fillwise.llm.common import out_batches, ship, small_side, stored
from fillwise.llm.components import components
from fillwise.session import discard

SHINGLE = 4
PERCENT = 80
BANDS = 25
ROWS = 5
#: Chosen probability of dropping a pair that reaches the threshold, at each batch.
MISS = 1e-5
#: Orders of the nodes by which a bucket's centres are chosen.
ORDERS = (0, -1, 0x5A5A5A5A5A5A5A5A, 0x3C3C3C3C3C3C3C3C)
#: Members of a bucket in one part of the all-with-all comparison.
PART = 1000
#: The same by shingles: parts get smaller where the texts are long.
PART_SHINGLES = 4_000_000
#: Sets that a task of the second reading remembers, to leave out copies.
SEEN = 100_000
#: Rows of candidate ids that may be broadcast to filter the second reading of the texts.
NEEDED_ROWS = 300_000

HASHES = BANDS * ROWS
U64 = np.uint64
_rng = np.random.default_rng(8)
_MUL = _rng.integers(0, 1 << 64, HASHES, dtype=U64) | U64(1)
_ADD = _rng.integers(0, 1 << 64, HASHES, dtype=U64)
_BAND = _rng.integers(0, 1 << 64, ROWS, dtype=U64) | U64(1)
_FOLD = [U64(0xA0761D6478BD642F), U64(0xE7037ED1A0B428DB), U64(0x8EBC6AF09C88C6E3), U64(0x589965CC75374CC3)]


def shingle_sets(b: textblocks.Block, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the sorted distinct shingles of each text."""
    w = textblocks.words(b, lower=True)
    n = len(w.hash)
    count = np.bincount(w.text, minlength=b.texts)
    first = np.concatenate([[0], np.cumsum(count)])[:-1]
    owners, found = [], []
    with np.errstate(over="ignore"):
        def folded(at: np.ndarray, k: int) -> np.ndarray:
            h = np.full(len(at), U64(k))
            for i in range(k):
                h = (h ^ w.hash[at + i]) * _FOLD[i % 4]
                h ^= h >> U64(31)
            return textblocks.mixed(h)

        if n >= shingle:
            at = np.flatnonzero(w.text[shingle - 1 :] == w.text[: n - shingle + 1])
            owners.append(w.text[at])
            found.append(folded(at, shingle))
        for k in range(1, shingle):
            texts = np.flatnonzero(count == k)
            owners.append(texts)
            found.append(folded(first[texts], k))
    owner, h = np.concatenate(owners), np.concatenate(found)
    order = np.lexsort((h, owner))
    owner, h = owner[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    owner, h = owner[new], h[new]
    return h, np.searchsorted(owner, np.arange(b.texts + 1))


def signatures(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """uint32 minima, one row per non-empty set (empty sets must not be among the bounds)."""
    out = np.empty((len(bounds) - 1, HASHES), np.uint32)
    with np.errstate(over="ignore"):
        for i in range(HASHES):
            out[:, i] = np.minimum.reduceat(((h * _MUL[i] + _ADD[i]) >> U64(32)).astype(np.uint32), bounds[:-1])
    return out


def sketch(docs: DataFrame, key: str, text: str, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, n, digest, signature) of every row; digest and signature null for an empty set."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("signature", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in textblocks.blocks(batch.column(1)):
                h, at = shingle_sets(b, shingle)
                n = np.diff(at)
                full = np.flatnonzero(n)
                sig = signatures(h, np.append(at[full], at[-1])) if len(full) else np.zeros((0, HASHES), np.uint32)
                row = np.cumsum(n > 0) - 1
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(b.first, b.texts), pa.array(n),
                    pa.array([xxhash.xxh3_128_digest(h[at[i] : at[i + 1]].tobytes()) if n[i] else None for i in range(b.texts)], pa.binary()),
                    pa.array([sig[row[i]].tobytes() if n[i] else None for i in range(b.texts)], pa.binary())], schema=schema)

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, n long, digest binary, signature binary")


def band_hashes(sig: np.ndarray) -> np.ndarray:
    """signatures -> a hash of each band and its number."""
    rows = sig.astype(U64).reshape(-1, BANDS, ROWS)
    with np.errstate(over="ignore"):
        h = np.zeros(rows.shape[:2], U64) + np.arange(BANDS, dtype=U64)
        for r in range(ROWS):
            h = textblocks.mixed((h ^ rows[:, :, r]) * _BAND[r])
    return h


def banded(classes: DataFrame) -> DataFrame:
    """(node, bucket): the hash of each band of the signature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = band_hashes(_matrix(batch.column(1)))
            node = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(h.ravel().view(np.int64))], ["node", "bucket"])

    return classes.select("node", "signature").mapInArrow(run, "node long, bucket long")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, HASHES)


def least_matches(n: int, percent: int = PERCENT, miss: float = MISS) -> int:
    """Fewest matches of n hashes at which P(similarity >= threshold) is still at least miss.
    The posterior is Beta(m + 1, n - m + 1), whose upper tail is a binomial sum."""
    t = percent / 100
    tail = 0.0
    for m in range(n + 1):  # P(J >= t | m of n) = P(Binomial(n + 1, t) <= m)
        tail += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        if tail >= miss:
            return m
    return n


BATCHES = [(i, least_matches(i)) for i in range(ROWS * 5, HASHES + 1, ROWS * 5)]


def plausible(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Indices of the row pairs that every batch of hashes leaves in."""
    alive = np.arange(len(a))
    matches = np.zeros(len(a), np.int64)
    done = 0
    for upto, least in BATCHES:
        matches = matches + (a[alive, done:upto] == b[alive, done:upto]).sum(1)
        keep = matches >= least
        alive, matches, done = alive[keep], matches[keep], upto
    return alive


def _similar_sizes(a: str, b: str):
    return (100 * F.least(a, b)) >= (PERCENT * F.greatest(a, b))


def prune(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b) -> those whose signatures stay plausible."""
    def side(name: str) -> DataFrame:
        return classes.select(F.col("node").alias(name), F.col("n").alias(f"n{name}"), F.col("signature").alias(f"s{name}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.select([0, 1]).take(pa.array(plausible(_matrix(batch.column(2)), _matrix(batch.column(3)))))

    joined = pairs.join(side("a"), "a").join(side("b"), "b").where(_similar_sizes("na", "nb"))
    return joined.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long").distinct()


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted sets reach the threshold."""
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    common = int((y[at] == x).sum())
    return 100 * common >= PERCENT * (len(x) + len(y) - common)


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) -> those whose full sets reach the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                keep.append(similar(np.frombuffer(x.as_py(), U64), np.frombuffer(y.as_py(), U64)))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    a = sets.select(F.col("node").alias("a"), F.col("hashes").alias("ha"))
    b = sets.select(F.col("node").alias("b"), F.col("hashes").alias("hb"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "ha", "hb").mapInArrow(run, "a long, b long")


def full_sets(docs: DataFrame, nodes: DataFrame, key: str, text: str, shingle: int = SHINGLE) -> DataFrame:
    """(node, digest, hashes) for the named documents: a second reading of their texts."""
    schema = pa.schema([("node", pa.int64()), ("digest", pa.binary()), ("hashes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            seen: set[tuple[int, bytes]] = set()
            for batch in batches:
                ids = batch.column(0).to_pylist()
                for b in textblocks.blocks(batch.column(1)):
                    h, at = shingle_sets(b, shingle)
                    for i in range(b.texts):
                        if at[i] < at[i + 1]:
                            hashes = h[at[i] : at[i + 1]].tobytes()
                            found = ids[b.first + i], xxhash.xxh3_128_digest(hashes)
                            if found not in seen:
                                yield *found, hashes
                                if len(seen) < SEEN:
                                    seen.add(found)

        yield from out_batches(rows(), schema)

    wanted = small_side(nodes.select(F.col("node").alias("_node")), NEEDED_ROWS)
    rows = docs.select(F.col(key).cast("long").alias("_id"), F.col(text).alias("_text"))
    return rows.join(wanted, F.col("_id") == F.col("_node"), "left_semi").mapInArrow(run, "node long, digest binary, hashes binary")


def unique_sets(docs: DataFrame, nodes: DataFrame, repeated: DataFrame, key: str, text: str, shingle: int = SHINGLE) -> DataFrame:
    """``full_sets`` with one row per (node, digest). ``repeated``: the nodes that have a set on
    several rows; only theirs are shuffled to leave out the copies."""
    if not repeated.limit(1).count():
        return full_sets(docs, nodes, key, text, shingle)
    once = full_sets(docs, nodes.join(repeated, "node", "left_anti"), key, text, shingle)
    more = full_sets(docs, nodes.join(repeated, "node", "left_semi"), key, text, shingle)
    return once.unionByName(more.dropDuplicates(["node", "digest"]))


def dealt_members(buckets: DataFrame, labelled: DataFrame, known: DataFrame) -> DataFrame:
    """(node, component, bucket, p, q, left): the members of open buckets in the blocks that they take part in."""
    sizes = known.groupBy("node").agg(F.sum("n").alias("n"))
    member = (buckets.join(sizes.join(labelled, "node", "left"), "node")
              .select("node", "bucket", "n", F.coalesce("component", "node").alias("component")))
    split = member.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.sum("n").alias("n"),
                                         F.count(F.lit(1)).alias("size")).where(F.col("lo") < F.col("hi"))
    parts = F.greatest(F.ceil(F.col("size") / PART), F.ceil(F.col("n") / PART_SHINGLES)).cast("int")
    open_ = (member.join(split.select("bucket", parts.alias("parts")), "bucket")
             .withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")))
    # each member goes to the blocks (p, q), p <= q, of which its part is one
    return open_.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "node", "component", "bucket", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"),
        (F.col("part") == F.least("part", "other")).alias("left"))


def cross_links(buckets: DataFrame, labelled: DataFrame, known: DataFrame) -> DataFrame:
    """(a, b): links between members of a bucket that are not yet in one component.
    ``buckets``: (node, bucket) of shared buckets; ``labelled``: (node, component) of linked
    nodes; ``known``: (node, n, signature, hashes).
    The pairs stay in the task; a pair is looked at in the first band that it shares."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        sig = np.frombuffer(b"".join(group["signature"]), np.uint32).reshape(-1, HASHES)
        node, comp, left = (group[c].to_numpy() for c in ("node", "component", "left"))
        full = [np.frombuffer(h, U64) for h in group["hashes"]]
        n = np.array([*map(len, full)])
        bands = sig.reshape(len(sig), BANDS, ROWS)
        here = band_hashes(sig) == group["bucket"].to_numpy().view(U64)[:, None]
        band = int(here.any(0).argmax())
        same = group["p"].iloc[0] == group["q"].iloc[0]
        others = np.arange(len(node)) if same else np.flatnonzero(~left)
        out = []
        for i in np.arange(len(node)) if same else np.flatnonzero(left):
            j = others[comp[others] != comp[i]]
            if same:
                j = j[node[j] > node[i]]
            j = j[100 * np.minimum(n[j], n[i]) >= PERCENT * np.maximum(n[j], n[i])]
            j = j[~(bands[j, :band] == bands[i, :band]).all(2).any(1)]
            j = j[plausible(np.broadcast_to(sig[i], (len(j), HASHES)), sig[j])]
            for k in j.tolist():
                if similar(full[i], full[k]):
                    out.append((max(node[i], node[k]), min(node[i], node[k])))
        return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)

    dealt = dealt_members(buckets, labelled, known)
    return dealt.join(known.drop("n"), "node").groupBy("bucket", "p", "q").applyInPandas(run, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept."""
    ship(docs.sparkSession)
    rows = stored(sketch(docs, key, text, shingle))
    named = rows.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    # written, so that the joins below shuffle plainly and a class of very many rows can be split
    heads = stored(named.groupBy("digest").agg(F.min("doc_id").alias("node")))
    classes = stored(named.join(heads, "digest").where(F.col("doc_id") == F.col("node"))
                     .groupBy("node", "digest").agg(F.first("n").alias("n"), F.first("signature").alias("signature"),
                                                    F.count(F.lit(1)).alias("copies")))

    bands = banded(classes)
    # a node meets one centre of its buckets in each of a few orders (node ^ c, ascending)
    first = [F.min(F.col("node").bitwiseXOR(F.lit(c))).alias(f"c{i}") for i, c in enumerate(ORDERS)]
    centres = bands.groupBy("bucket").agg(*first, F.count(F.lit(1)).alias("members")).where(F.col("members") > 1).drop("members")
    shared = stored(bands.join(centres, "bucket"))
    met = shared.groupBy("node").agg(*[F.min(f"c{i}").alias(f"c{i}") for i in range(len(ORDERS))])
    met = stored(met.select("node", F.explode(F.array(*[F.col(f"c{i}").bitwiseXOR(F.lit(c)) for i, c in enumerate(ORDERS)])).alias("centre")))
    stars = (met.where(F.col("node") != F.col("centre"))
             .select(F.greatest("node", "centre").alias("a"), F.least("node", "centre").alias("b")).distinct())
    repeated = classes.where(F.col("copies") > 1).select("node").distinct()
    sets = stored(unique_sets(docs, met.select("node").distinct(), repeated, key, text, shingle))

    links = stored(verify(prune(stars, classes), sets))
    labelled = stored(components(links))
    known = stored(classes.select("node", "digest", "n", "signature").join(sets, ["node", "digest"]).drop("digest"))
    discard(docs.sparkSession, classes, sets, met)
    links = links.unionByName(stored(cross_links(shared.select("node", "bucket"), labelled, known)))
    discard(docs.sparkSession, shared, known)

    # a document with several texts ties their classes together
    heads_of = rows.join(heads, "digest", "left").select("doc_id", "n", "node")
    ties = (heads_of.where(F.col("node").isNotNull()).groupBy("doc_id")
            .agg(F.min("node").alias("a"), F.max("node").alias("b")).where(F.col("a") < F.col("b")))
    every = heads_of.join(ties.select("doc_id", "a"), "doc_id").select("a", F.col("node").alias("b"))
    final = stored(components(links.unionByName(every)))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id"))
    return heads_of.join(final, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
