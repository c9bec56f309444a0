"""Phrase collocation mining by direct-address tiles over frequency-ranked word ids.

Words are counted per language. The most frequent ones (``RANKED`` at most, over all
languages) get ids by falling frequency; the plane of (left id, right id) of a language is
tiled by strips whose borders are powers of 4, so that tiles near the origin are small and full
and others large and sparse. Adjacent pairs are counted where they are read: a tile of at most
``DENSE`` cells by ``numpy.bincount`` over its local addresses, a larger one as sorted
coordinates with counts (COO). Counts are packed by tile or coordinate bucket,
shuffled, and added in the same two ways; dense tiles are added ``FAN`` parts at a time, so a
tile that every task has parts of is not one task's work. Pairs that are frequent enough are
ranked again by falling frequency and become the left ids of the next level, which counts
phrases of three words as pairs (pair, word), and so on up to ``longest`` words.

Whatever has no rank goes the same way with a 63-bit hash as its code, always as COO, so no
rank bound loses a phrase. A word or a phrase that occurs too seldom can be part of no
candidate: a bitmap of fixed size (``BITS``) of the frequent ones' codes leaves out most of
those; the few that share a bit with a frequent one are only counted for nothing.

Broadcast are the ranked codes (``RANKED`` of 8 bytes) and the bitmap (``BITS`` / 8 bytes).

Rows: null text is empty, null language ``und``; texts are read whole; repeated rows count as
often as they are there. Only the two named columns are read, so others may have any name. An
empty table, or one without frequent phrases, gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from fillwise.llm import textblocks
from fillwise.llm.common import out_batches, ship, stored
from fillwise.session import ARROW_BYTES

#: Words, and phrases of a level, that get ids at most.
RANKED = 1 << 18
RANK_BITS = 18
#: Bits of the filter of frequent codes.
BITS = 1 << 27
#: Cells of a tile that is counted as a dense array.
DENSE = 1 << 20
#: Pairs that a task gathers before it counts them.
GATHER = 1 << 18
#: Words of blocks that a task gathers before it puts them together.
WORDS_HELD = 500_000
#: Words of a row of encoded text, if its pieces allow: rows of some MB are kept whole by the page,
#: outside the heap, where Spark writes and reads them.
ROW_WORDS = 1 << 14
#: Counted words of a batch.
WORD_ROWS = 10_000
#: Bytes of rows that a task hands to Python at once.
HANDED = "2m"
#: Pairs that share a bucket of coordinates, about.
BUCKET = 1 << 20
#: Parts of a dense tile that are added at once.
FAN = 64

MIN_COUNT = 10
LONGEST = 3
TOP = 2000
#: A candidate goes if a longer one that holds it occurs in this share (percent) of its places.
INSIDE = 50
SCALE = 1_000_000

U64, I64 = np.uint64, np.int64
NONE = np.iinfo(I64).max
_HASHED = U64(1) << U64(63)
_MIXED = U64(3) << U64(62)
FIRST_BITS = 8
LOCAL_BITS = 2 * RANK_BITS

#: Separators of words and of pieces.
_WORD_END = np.zeros(256, bool)
_PIECE_END = np.zeros(256, bool)
_PIECE_END[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_WORD_END[[0x20, 0x09]] = True
_WORD_END |= _PIECE_END


# --- words

@dataclass
class Words:
    data: np.ndarray  # lower-cased bytes
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    code: np.ndarray  # int64 below zero: hash of language and word
    opens: np.ndarray  # first word of its piece


def words(b: textblocks.Block, language: np.ndarray) -> Words:
    """The words of a block of texts; ``language`` holds the hash of each text's."""
    data = np.where((b.data >= 65) & (b.data <= 90), b.data + 32, b.data).astype(np.uint8)
    n = len(data)
    ends = _WORD_END[data]
    edge = np.zeros(n + 1, bool)
    edge[b.bounds] = True
    start = np.flatnonzero(~ends & (np.concatenate([[True], ends[:-1]]) | edge[:-1])) if n else np.zeros(0, I64)
    end = np.flatnonzero(~ends & (np.concatenate([ends[1:], [True]]) | edge[1:])) + 1 if n else start
    text = np.searchsorted(b.bounds, start, "right") - 1
    piece = np.cumsum(_PIECE_END[data])[start] if n else start
    opens = np.ones(len(start), bool)
    opens[1:] = (text[1:] != text[:-1]) | (piece[1:] != piece[:-1])
    with np.errstate(over="ignore"):
        h = textblocks.mixed(textblocks.hashes(data, start, end) + language[text] * U64(0x9E3779B97F4A7C15))
    return Words(data, start, end, text, (h | _HASHED).view(I64), opens)


def _languages(column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(names, index of each row, hash of each row); null counts as ``und``."""
    coded = column.fill_null("und").dictionary_encode()
    names = coded.dictionary.to_pylist()
    at = coded.indices.to_numpy(zero_copy_only=False)
    h = np.array([xxhash.xxh64_intdigest(x, 5) for x in names], U64)
    return names, at, h[at] if len(names) else np.zeros(len(at), U64)


_COUNTED = pa.schema([("lang", pa.string()), ("word", pa.string()), ("code", pa.int64()), ("n", pa.int64())])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the blocks with their counts, those of several blocks put together."""
    held: list[tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]] = []
    size = 0

    def merged() -> tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]:
        code, first, back = np.unique(np.concatenate([h[0] for h in held]), return_index=True, return_inverse=True)
        n = np.bincount(back, np.concatenate([h[1] for h in held]), len(code)).astype(I64)
        return code, n, *(pa.concat_arrays([h[i] for h in held]).take(pa.array(first)) for i in (2, 3))

    for batch in batches:
        names, at, h = _languages(batch.column(1))
        for b in textblocks.blocks(batch.column(0)):
            w = words(b, h[b.first : b.first + b.texts])
            code, first, n = np.unique(w.code, return_index=True, return_counts=True)
            start, length = w.start[first], w.end[first] - w.start[first]
            ends = np.concatenate([[0], np.cumsum(length)])
            spelt = w.data[np.repeat(start - ends[:-1], length) + np.arange(ends[-1])]
            word = pa.LargeStringArray.from_buffers(len(code), pa.py_buffer(ends.astype(I64)), pa.py_buffer(spelt)).cast(pa.string())
            lang = pa.array(names, pa.string()).take(pa.array(at[b.first : b.first + b.texts][w.text[first]]))
            held.append((code, n, word, lang))
            size += len(code)
            if size > WORDS_HELD:
                held = [merged()]
                size = len(held[0][0])
                if 2 * size > WORDS_HELD:
                    yield from _word_batches(*held[0])
                    held, size = [], 0
    if held:
        yield from _word_batches(*merged())


def _word_batches(code: np.ndarray, n: np.ndarray, word: pa.Array, lang: pa.Array) -> Iterator[pa.RecordBatch]:
    whole = pa.RecordBatch.from_arrays([lang, word, pa.array(code), pa.array(n)], schema=_COUNTED)
    for at in range(0, len(code), WORD_ROWS):
        yield whole.slice(at, WORD_ROWS)


# --- ids

@dataclass
class Ids:
    """Ranked codes and the filter of frequent ones. Ids run through the languages, within one
    by falling frequency."""
    names: dict[str, int]  # numbers of languages
    code: np.ndarray  # ascending
    id: np.ndarray  # of each code
    language: np.ndarray  # of each id
    rank: np.ndarray  # of each id, within its language
    bits: np.ndarray

    def of(self, code: np.ndarray) -> np.ndarray:
        """Ids of codes; the code itself where it has none, ``NONE`` where it is too seldom."""
        if not len(self.code):
            return np.where(self.frequent(code), code, NONE)
        at = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
        found = self.code[at] == code
        out = np.where(found, self.id[at], code)
        rest = np.flatnonzero(~found)
        out[rest[~self.frequent(code[rest])]] = NONE
        return out

    def frequent(self, code: np.ndarray) -> np.ndarray:
        p = _bit(code, len(self.bits) * 8)
        return (self.bits[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1


def _bit(code: np.ndarray, bits: int) -> np.ndarray:
    return (textblocks.mixed(code.view(U64)) % U64(bits)).astype(I64)


def _ranked(frequent: DataFrame, ranked: int) -> pa.Table:
    """The most frequent rows (lang, code, f), at most ``ranked``: all from a frequency up,
    found from counts of rows by eighths of octaves."""
    step = F.floor(8 * F.log2("f")).cast("int")
    found, least = 0, None
    for r in sorted(frequent.groupBy(step.alias("step")).count().collect(), key=lambda r: -r["step"]):
        if found + r["count"] > ranked:
            break
        found, least = found + r["count"], r["step"]
    return frequent.where(F.lit(False) if least is None else step >= least).select("lang", "code", "f").toArrow()


def _bitmap(frequent: DataFrame, bits: int) -> np.ndarray:
    """One bit for every code, put together by chunks in tasks."""
    chunk = min(bits, 1 << 19)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = _bit(batch.column(0).to_numpy(zero_copy_only=False), bits)
            yield pa.RecordBatch.from_arrays([pa.array(p // chunk), pa.array((p % chunk).astype(np.int32))], ["chunk", "at"])

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags, now = np.zeros(chunk, bool), None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now]), pa.array([np.packbits(flags, bitorder="little").tobytes()])],
                                              ["chunk", "bits"])

        for batch in batches:
            c, at = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for k in np.unique(c).tolist():  # ascending, as the rows are sorted
                if k != now:
                    if now is not None:
                        yield done()
                    now = k
                    flags[:] = False
                flags[at[c == k]] = True
        if now is not None:
            yield done()

    found = (frequent.select("code").mapInArrow(places, "chunk long, at int").distinct().repartition("chunk")
             .sortWithinPartitions("chunk").mapInArrow(chunks, "chunk long, bits binary"))
    out = np.zeros(bits // 8, np.uint8)
    for r in found.collect():  # BITS / 8 bytes in all
        out[r["chunk"] * (chunk // 8) :][: chunk // 8] = np.frombuffer(r["bits"], np.uint8)
    return out


def ids(frequent: DataFrame, ranked: int = RANKED, bits: int = BITS, names: dict[str, int] | None = None) -> Ids:
    """Ids of a stored table (lang, code, f) of frequent words or phrases. ``names`` numbers the
    languages of the words; phrases keep these numbers."""
    rows = _ranked(frequent, ranked)
    names = dict(names or {})
    spelt = rows["lang"].to_pylist()
    for x in sorted(set(spelt) - set(names)):
        names[x] = len(names)
    lang = np.array([names[x] for x in spelt], I64)
    code, f = (rows[c].to_numpy().astype(I64) for c in ("code", "f"))
    order = np.lexsort((code, -f, lang))
    lang, code = lang[order], code[order]
    rank = np.arange(len(lang)) - np.searchsorted(lang, lang)
    at = np.argsort(code)
    return Ids(names, code[at], at, lang, rank, _bitmap(frequent, bits))


def pair_codes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Codes of pairs of ids or codes: exact where both have ids, else a hash; all below zero."""
    both = (left >= 0) & (right >= 0)
    exact = ((left << RANK_BITS) | right).view(U64) | _HASHED
    with np.errstate(over="ignore"):
        h = textblocks.mixed(left.view(U64) * U64(0xD6E8FEB86659FD93) + textblocks.mixed(right.view(U64)))
    out = np.where(both, exact, h | _MIXED)
    return out.view(I64)


# --- tiles

def _strip(rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(strip, place in it, its width): [0, 256), [256, 1024), [1024, 4096) ..."""
    s = np.maximum(np.frexp(rank.astype(np.float64))[1] - FIRST_BITS + 1, 0) // 2
    low = np.where(s > 0, 1 << (FIRST_BITS + 2 * (s - 1)), 0)
    return s, rank - low, np.where(s > 0, 3 * low, 1 << FIRST_BITS)


def _width(strip: int) -> int:
    return 3 << (FIRST_BITS + 2 * (strip - 1)) if strip else 1 << FIRST_BITS


def _area(tile: int) -> int:
    return _width(tile >> 3 & 7) * _width(tile & 7)


def addresses(left: np.ndarray, right: np.ndarray, left_ids: Ids, right_ids: Ids) -> np.ndarray:
    """Tile (language, strip, strip) and local address of pairs of ids."""
    s, i, _ = _strip(left_ids.rank[left])
    t, j, width = _strip(right_ids.rank[right])
    tile = (right_ids.language[right] << 6) | (s << 3) | t
    return (tile << LOCAL_BITS) | (i * width + j)


def located(address: np.ndarray, left_ids: Ids, right_ids: Ids) -> tuple[np.ndarray, np.ndarray]:
    """The ids at addresses."""
    tile, local = address >> LOCAL_BITS, address & ((1 << LOCAL_BITS) - 1)
    s, t = tile >> 3 & 7, tile & 7
    widths, lows = np.array([_width(k) for k in range(8)]), np.array([0, *[1 << (FIRST_BITS + 2 * k) for k in range(7)]])
    i, j = local // widths[t] + lows[s], local % widths[t] + lows[t]
    return np.searchsorted(left_ids.language, tile >> 6) + i, np.searchsorted(right_ids.language, tile >> 6) + j


def _grouped(keys: tuple[np.ndarray, ...], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct keys, sorted, and the sums of their counts: a tile as sorted coordinates."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    keys = tuple(k[order] for k in keys)
    new = np.ones(len(order), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], 0)
    at = np.flatnonzero(new)
    return [k[at] for k in keys], np.add.reduceat(n[order], at) if len(at) else n[:0]


_PACKED = pa.schema([("kind", pa.int32()), ("slot", pa.int64()), ("part", pa.int64()), ("left", pa.binary()),
                     ("right", pa.binary()), ("n", pa.binary())])
_PACKED_SQL = "kind int, slot long, part long, left binary, right binary, n binary"
TILE, SPARSE, HASHED = 0, 1, 2


def _packed(kind: int, slot: np.ndarray, part: int, keys: list[np.ndarray], n: np.ndarray) -> Iterator[tuple]:
    order = np.argsort(slot, kind="stable")
    slot, n, keys = slot[order], n[order], [k[order] for k in keys]
    edges = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1], [True]])) if len(slot) else np.zeros(1, I64)
    for a, b in zip(edges, edges[1:]):
        right = keys[1][a:b].tobytes() if len(keys) > 1 else b""
        yield kind, int(slot[a]), part, keys[0][a:b].tobytes(), right, n[a:b].astype(np.int32).tobytes()


def _counted(left: np.ndarray, right: np.ndarray, left_ids: Ids, right_ids: Ids, buckets: int, part: int) -> Iterator[tuple]:
    """Counts of pairs, packed: dense tiles by tile, other coordinates by bucket."""
    both = (left >= 0) & (right >= 0)
    address = np.sort(addresses(left[both], right[both], left_ids, right_ids))
    tile = address >> LOCAL_BITS
    edges = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1], [True]])) if len(tile) else np.zeros(1, I64)
    sparse = []
    for a, b in zip(edges, edges[1:]):
        t, area = int(tile[a]), _area(int(tile[a]))
        if area > DENSE:
            sparse.append(address[a:b])
            continue
        n = np.bincount(address[a:b] & ((1 << LOCAL_BITS) - 1), minlength=area)
        cell = np.flatnonzero(n)
        yield TILE, t, part, cell.astype(np.int32).tobytes(), b"", n[cell].astype(I64).tobytes()
    if sparse:
        (address,), n = _grouped((np.concatenate(sparse),), np.ones(sum(map(len, sparse)), I64))
        slot = (textblocks.mixed(address.view(U64)) % U64(buckets)).astype(I64)
        yield from _packed(SPARSE, slot, part, [address], n)
    keys, n = _grouped((left[~both], right[~both]), np.ones(int((~both).sum()), I64))
    slot = (textblocks.mixed(pair_codes(*keys).view(U64)) % U64(buckets)).astype(I64)
    yield from _packed(HASHED, slot, part, keys, n)


# --- levels

def _encode(docs: DataFrame, known) -> DataFrame:
    """The texts as ids of their words (int32; -1 opens a piece or stands for words that are too
    seldom, -2 - k for the k-th hashed code in ``more``), in rows of whole pieces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("ids", pa.binary()), ("more", pa.binary())])

        def rows() -> Iterator[tuple]:
            for batch in batches:
                _, _, h = _languages(batch.column(1))
                for b in textblocks.blocks(batch.column(0)):
                    w = words(b, h[b.first : b.first + b.texts])
                    code = known.value.of(w.code)
                    at = np.arange(len(code)) + np.cumsum(w.opens)  # a break before every piece
                    seq = np.full(len(code) + int(w.opens.sum()), NONE, I64)
                    seq[at] = code
                    for part in _rows(seq, at[w.opens] - 1):
                        hashed = part < 0
                        small = np.where(part == NONE, -1, np.where(hashed, -1 - np.cumsum(hashed), part)).astype(np.int32)
                        yield small.tobytes(), part[hashed].tobytes()

        yield from out_batches(rows(), schema)

    return docs.mapInArrow(run, "ids binary, more binary")


def _rows(seq: np.ndarray, breaks: np.ndarray) -> Iterator[np.ndarray]:
    """``seq`` cut at breaks (ascending, the first at 0) into rows of about ``ROW_WORDS``; a longer piece stays whole."""
    edges = [*np.searchsorted(breaks, np.arange(0, len(seq), ROW_WORDS)).tolist(), len(breaks)]
    places = np.unique(np.append(breaks, len(seq))[edges])
    for a, b in zip(places, places[1:]):
        yield seq[a:b]


def _sequence(ids: bytes, more: bytes) -> np.ndarray:
    seq = np.frombuffer(ids, np.int32).astype(I64)
    seq[seq == -1] = NONE
    hashed = np.flatnonzero(seq < 0)
    seq[hashed] = np.frombuffer(more, I64)
    return seq


def _level(coded: DataFrame, levels: list, buckets: int, least: int) -> DataFrame:
    """(left, right, n) of phrases one word longer than ``levels`` has, that occur at least
    ``least`` times. ``levels`` holds the broadcast ids of words, pairs and so on."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 20
        words_ids, left_ids = levels[0].value, levels[-1].value
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            left, right = (np.concatenate(x) for x in zip(*held))
            held.clear()
            yield from out_batches(_counted(left, right, left_ids, words_ids, buckets, part), _PACKED)

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                word = _sequence(a, b)
                unit = word
                for k, level in enumerate(levels[1:], 1):  # phrases of k + 1 words from those of k
                    left, right = unit[:-1], word[k:]
                    ok = (left != NONE) & (right != NONE)
                    unit = np.full(len(left), NONE, I64)
                    unit[ok] = level.value.of(pair_codes(left[ok], right[ok]))
                left, right = unit[:-1], word[len(levels) :]
                ok = (left != NONE) & (right != NONE) & (unit[1:] != NONE)
                held.append((left[ok], right[ok]))
                size += int(ok.sum())
                if size >= GATHER:
                    yield from flush()
                    part, size = part + 1, 0
        if held:
            yield from flush()

    packed = stored(coded.mapInArrow(count, _PACKED_SQL))

    counted = pa.schema([("left", pa.int64()), ("right", pa.int64()), ("n", pa.int64())])

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray]]:
        """(slot, part, sums of the cells) of parts that follow each other."""
        total, now = None, None
        for batch in batches:
            for slot, part, cell, n in zip(*(batch.column(c).to_pylist() for c in ("slot", "part", "left", "n"))):
                if (slot, part) != now:
                    if now is not None:
                        yield *now, total
                    total, now = np.zeros(_area(slot), I64), (slot, part)
                total[np.frombuffer(cell, np.int32)] += np.frombuffer(n, I64)
        if now is not None:
            yield *now, total

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for slot, part, total in totals(batches):
                cell = np.flatnonzero(total)
                yield TILE, slot, part, cell.astype(np.int32).tobytes(), b"", total[cell].tobytes()

        yield from out_batches(rows(), _PACKED)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole tiles: frequent cells back to ids."""
        for slot, _, total in totals(batches):
            cell = np.flatnonzero(total >= least)
            pair = located((slot << LOCAL_BITS) | cell, levels[-1].value, levels[0].value)
            yield pa.RecordBatch.from_arrays([*map(pa.array, pair), pa.array(total[cell])], schema=counted)

    tiles = packed.where(F.col("kind") == TILE)
    most = tiles.groupBy("slot").count().agg(F.max("count")).first()[0] or 1
    while True:  # parts of a tile are added in groups of about FAN, until one is left
        most = -(-most // FAN)
        dealt = (tiles.withColumn("part", F.pmod(F.xxhash64("part"), F.lit(most))).repartition("slot", "part")
                 .sortWithinPartitions("slot", "part"))
        if most == 1:
            break
        tiles = stored(dealt.mapInArrow(add, _PACKED_SQL))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Buckets of coordinates: sorted, added, filtered."""
        held: list[tuple] = []

        def done(kind: int) -> pa.RecordBatch:
            keys = [np.concatenate([np.frombuffer(h[i], I64) for h in held]) for i in range(2 if kind == HASHED else 1)]
            keys, n = _grouped(tuple(keys), np.concatenate([np.frombuffer(h[2], np.int32) for h in held]).astype(I64))
            held.clear()
            keys, n = [k[n >= least] for k in keys], n[n >= least]
            pair = keys if kind == HASHED else located(keys[0], levels[-1].value, levels[0].value)
            return pa.RecordBatch.from_arrays([*map(pa.array, pair), pa.array(n)], schema=counted)

        now = None
        for batch in batches:
            for kind, slot, *row in zip(*(batch.column(c).to_pylist() for c in ("kind", "slot", "left", "right", "n"))):
                if (kind, slot) != now:
                    if held:
                        yield done(now[0])
                    now = kind, slot
                held.append(tuple(row))
        if held:
            yield done(now[0])

    rest = packed.where(F.col("kind") != TILE).repartition("kind", "slot").sortWithinPartitions("kind", "slot")
    out = "left long, right long, n long"
    # one Python function a task: each chained one would be another worker process beside it
    return stored(dealt.mapInArrow(finish, out).unionByName(rest.mapInArrow(merge, out)))


def _codes(coded: DataFrame, known) -> DataFrame:
    """``coded`` with the id or code (column ``unit``) that the counting uses for its ``code``."""
    fields = StructType([*coded.schema.fields, StructField("unit", LongType())])
    at = coded.columns.index("code")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = known.value.of(batch.column(at).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(unit)], [*batch.schema.names, "unit"])

    return coded.mapInArrow(run, fields)


def _pair_code(df: DataFrame) -> DataFrame:
    """``code`` of (left, right)."""
    fields = StructType([*df.schema.fields, StructField("code", LongType())])
    a, b = df.columns.index("left"), df.columns.index("right")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = pair_codes(*(batch.column(i).to_numpy(zero_copy_only=False) for i in (a, b)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code)], [*batch.schema.names, "code"])

    return df.mapInArrow(run, fields)


@dataclass
class Counts:
    """``words``: lang, word, f of every word. ``vocabulary``: lang, word, unit of frequent ones.
    ``phrases``: lang, units (of the words, in order), f; every frequent word and phrase."""
    words: DataFrame
    vocabulary: DataFrame
    phrases: DataFrame


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs inside hands rows to Python ``HANDED`` at a time."""
    ship(spark)
    before = spark.conf.get(ARROW_BYTES)
    spark.conf.set(ARROW_BYTES, HANDED)
    try:
        yield
    finally:
        spark.conf.set(ARROW_BYTES, before)


def count_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = MIN_COUNT, longest: int = LONGEST,
                  ranked: int = RANKED, bits: int = BITS) -> Counts:
    """All phrases of 1 to ``longest`` words that occur at least ``least`` times in their language."""
    if not 0 < ranked <= RANKED:
        raise ValueError(f"ranked must be 1 to {RANKED}")
    with _small_batches(docs.sparkSession):
        return _count_phrases(docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")), least, longest, ranked, bits)


def _count_phrases(docs: DataFrame, least: int, longest: int, ranked: int, bits: int) -> Counts:
    spark = docs.sparkSession
    every = stored(docs.mapInArrow(_count_words, "lang string, word string, code long, n long")
                   .groupBy("lang", "word").agg(F.max("code").alias("code"), F.sum("n").alias("f")))
    frequent = stored(every.where(F.col("f") >= least))
    known = spark.sparkContext.broadcast(ids(frequent, ranked, bits))
    vocabulary = stored(_codes(frequent, known).select("lang", "word", "unit", "f"))
    phrases = level = vocabulary.select("lang", F.array("unit").alias("units"), "unit", "f")
    total = every.agg(F.sum("f")).first()[0] or 0
    coded, levels = stored(_encode(docs, known)), [known]
    for size in range(2, longest + 1):
        found = _pair_code(_level(coded, levels, total // BUCKET + 1, least))
        grown = stored(level.join(found.withColumnRenamed("left", "unit"), "unit")
                       .select("lang", F.concat("units", F.array("right")).alias("units"), "code", F.col("n").alias("f")))
        if size < longest:
            levels.append(spark.sparkContext.broadcast(ids(grown, ranked, bits, known.value.names)))
            level = stored(_codes(grown, levels[-1]).select("lang", "units", "unit", "f"))
        else:
            level = grown
        phrases = phrases.select("lang", "units", "f").unionByName(level.select("lang", "units", "f"))
    return Counts(every.select("lang", "word", "f"), vocabulary, stored(phrases))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = MIN_COUNT, longest: int = LONGEST,
                 top: int = TOP, ranked: int = RANKED, bits: int = BITS) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score. A phrase's
    score is the least, over its cuts in two, of a * a / (l * r) in millionths."""
    counts = count_phrases(docs, text, lang, least, longest, ranked, bits)
    known = counts.phrases.select("units", "f")
    candidates = counts.phrases.where(F.size("units") > 1)
    size = F.size("units")

    def part(name: str, units: str) -> DataFrame:
        return known.select(F.col("units").alias(units), F.col("f").alias(name))

    cuts = (candidates.select("lang", "units", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
            .withColumn("head", F.slice("units", F.lit(1), F.col("k")))
            .withColumn("tail", F.slice("units", F.col("k") + 1, F.size("units") - F.col("k")))
            .join(part("l", "head"), "head").join(part("r", "tail"), "tail"))
    big = [F.col(c).cast("decimal(19,0)") for c in "alr"]
    up, down = (F.lit(SCALE).cast("decimal(7,0)") * big[0]).cast("decimal(26,0)"), (big[1] * big[2]).cast("decimal(38,0)")
    cuts = cuts.withColumns({"_up": (up * big[0]).cast("decimal(38,0)"), "_down": down}).withColumn("score", F.expr("_up div _down"))
    scored = (cuts.groupBy("units").agg(F.min(F.struct("score", "k", "lang", "a", "l", "r")).alias("_best"))
              .select("units", "_best.*"))
    # parts of longer candidates, their ends being words of the candidate
    spans = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.size("units") - m + 1), lambda i: F.slice("units", i, m))))
    longer = (candidates.where(size > 2).select(F.explode(spans).alias("units"), "f")
              .groupBy("units").agg(F.max("f").alias("_longer")))
    left = scored.join(longer, "units", "left").where(
        F.col("_longer").isNull() | (100 * F.col("_longer") < INSIDE * F.col("a")))
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc())
    near = stored(left.withColumn("_rank", F.rank().over(best)).where(F.col("_rank") <= top).drop("_rank"))
    named = (near.select("units", F.posexplode("units").alias("_i", "unit"))
             .join(counts.vocabulary.select("unit", "word"), "unit").groupBy("units")
             .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_i", "word"))), lambda x: x["word"]), " ").alias("phrase")))
    n = counts.words.groupBy("lang").agg(F.sum("f").alias("n"))
    place = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    return (near.join(named, "units").withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)
            .join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
                                    F.col("score").cast("long").alias("score")))
