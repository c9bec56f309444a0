"""Vectorised word access to whole texts: an Arrow string column as blocks of raw bytes,
with the bounds, owners and 64-bit hashes of its words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes of text that are handled at once; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20
#: Longer words are hashed one by one.
SHORT_WORD = 32

U64 = np.uint64
_rng = np.random.default_rng(20240229)
_TABLE = _rng.integers(0, 1 << 64, 256, dtype=np.uint64)
_STEP = U64(0x9E3779B97F4A7C15)

#: Word separators: space and the control characters 9 to 13.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> U64(32))) * U64(0xD6E8FEB86659FD93)
        h = (h ^ (h >> U64(32))) * U64(0xD6E8FEB86659FD93)
    return h ^ (h >> U64(32))


@dataclass
class Block:
    first: int  # row of the first text
    data: np.ndarray  # uint8
    bounds: np.ndarray  # int64, texts + 1

    @property
    def texts(self) -> int:
        return len(self.bounds) - 1


@dataclass
class Words:
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray  # index of the text within the block
    hash: np.ndarray


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds) of a string column; null counts as empty."""
    column = column.fill_null("") if column.null_count else column
    large = pa.types.is_large_string(column.type)
    n = len(column)
    at = np.frombuffer(column.buffers()[1], np.int64 if large else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    if n == 0 or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(column.buffers()[2], np.uint8)[at[0] : at[-1]], at - at[0]


def blocks(column: pa.Array, most: int = BLOCK_BYTES) -> Iterator[Block]:
    data, at = raw(column)
    n, i = len(at) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
        yield Block(i, data[at[i] : at[j]], at[i : j + 1] - at[i])
        i = j


def words(b: Block, lower: bool = False, with_hash: bool = True) -> Words:
    """Maximal runs of bytes that are not separators, within one text each."""
    data = b.data
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return Words(z, z, z, np.zeros(0, U64))
    if lower:
        data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    space = IS_SPACE[data]
    before = np.empty(n, bool)
    before[0], before[1:] = True, space[:-1]
    after = np.empty(n, bool)
    after[-1], after[:-1] = True, space[1:]
    cut = b.bounds[1:-1]
    before[cut[cut < n]] = True
    after[cut[cut > 0] - 1] = True
    start = np.flatnonzero(~space & before)
    end = np.flatnonzero(~space & after) + 1
    owner = np.searchsorted(b.bounds, start, "right") - 1
    return Words(start, end, owner, hashes(data, start, end) if with_hash else np.zeros(0, U64))


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    length = end - start
    h = length.astype(U64) * _STEP
    order = np.argsort(-np.minimum(length, SHORT_WORD + 1), kind="stable")
    long = int(np.searchsorted(-np.minimum(length, SHORT_WORD + 1)[order], -SHORT_WORD, "left"))
    s, rest = start[order], -length[order]
    out = h[order]
    with np.errstate(over="ignore"):
        for k in range(SHORT_WORD):
            m = int(np.searchsorted(rest[long:], -k, "left")) + long  # words longer than k
            if m <= long:
                break
            out[long:m] = (out[long:m] ^ _TABLE[data[s[long:m] + k]]) * _STEP
            out[long:m] ^= out[long:m] >> U64(29)
    for i in range(long):
        out[i] = xxhash.xxh64_intdigest(data[start[order[i]] : end[order[i]]].tobytes(), 1)
    h[order] = out
    return mixed(h)


def per_text(b: Block, owner: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(owner, weights, b.texts)
