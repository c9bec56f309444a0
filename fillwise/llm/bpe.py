"""Byte-level BPE by backtracking over longest matches.

A text is split by the tokenizer's pattern; every match is encoded by itself. The bytes
of a piece are mapped to Latin-1 characters, and the vocabulary's Aho-Corasick trie gives
the longest match at a position. The encoder takes the longest token there, keeps it when
it is *compatible* with the token before it, and otherwise tries the next shorter one; a
position from which no token works is marked dead and never visited again. Two adjacent tokens are compatible when no merge crosses their border, and
a sequence whose neighbours are all compatible is exactly what the merges leave, so the
result equals the merge loop's at a cost linear in the piece. Compatibility depends on the
two tokens only and is memoised, as are whole pieces (bounded memos, which change no result).

Null texts count as empty; an empty text has no tokens and decodes to nothing. Rows are
independent, so repeated rows, ties and null ids need no rule. Only the named columns are
read, so other columns may have any name.
"""

from __future__ import annotations

import base64
import re
import struct
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillwise.llm.common import out_batches, ship

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Entries that a worker keeps of whole pieces and of token pairs.
PIECES_KEPT = 300_000
PAIRS_KEPT = 600_000
FAR = 1 << 60
#: Texts whose characters are all below this code point are split by the standard
#: library's faster regex engine, with the character classes written out.
COMMON = 0x250
SPACE = "\\t-\\r \\x85\\xa0"


def _class(major: str) -> str:
    """The characters below COMMON of a Unicode general category, as a regex class."""
    points = [i for i in range(COMMON) if unicodedata.category(chr(i))[0] == major]
    return "".join(re.escape(chr(i)) for i in points)


def common_pattern(pattern: str) -> str:
    """``pattern`` for characters below COMMON, without property classes."""
    letters, digits = _class("L"), _class("N")
    out = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{SPACE}{letters}{digits}]")
    out = out.replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{digits}]")
    return out.replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]")


class Tokenizer:
    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.rank = {base64.b64decode(token): int(r) for token, r in pairs}
        self.size = max(self.rank.values()) + 1
        self.token = [b""] * self.size
        for t, r in self.rank.items():
            self.token[r] = t
        self.longest = max(map(len, self.rank))
        self.words = regex.compile(pattern)
        self.common = self.plain = None
        common = common_pattern(pattern)
        if r"\p" not in common:
            self.common = re.compile(common)
            # alternatives that begin with an apostrophe can't match where there is none
            rest = common.split("|")
            self.plain = re.compile("|".join(x for x in rest if not x.startswith("'")))
        self.uncommon = re.compile(f"[{chr(COMMON)}-{chr(0x10FFFF)}]")
        self.trie = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for t, r in self.rank.items():
            self.trie.add_word(t.decode("latin-1"), r)
        self._spines: dict[tuple[int, bool], list[tuple[bytes, int, int]]] = {}
        self._fits: dict[int, bool] = {}

    # -- merge history of a token -------------------------------------------------
    def _halves(self, t: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``t`` (None for a single byte)."""
        parts = [bytes([b]) for b in self.token[t]]
        while len(parts) > 2:
            best, at = FAR, -1
            for i in range(len(parts) - 1):
                r = self.rank.get(parts[i] + parts[i + 1], FAR)
                if r < best and r != t:
                    best, at = r, i
            if at < 0:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return (self.rank[parts[0]], self.rank[parts[1]]) if len(parts) == 2 else None

    def _spine(self, t: int, right: bool) -> list[tuple[bytes, int, int]]:
        """(bytes, from, until): what stands at the right (left) edge of ``t`` while it is
        built. It is there from its own merge on, until the merge that swallows it."""
        key = (t, right)
        if key not in self._spines:
            out, until = [], FAR
            while True:
                halves = self._halves(t)
                out.append((self.token[t], t if halves else -1, until))
                if not halves:
                    break
                until, t = t, halves[1 if right else 0]
            self._spines[key] = out
        return self._spines[key]

    def fits(self, a: int, b: int) -> bool:
        """Whether no merge crosses the border between adjacent tokens a and b."""
        key = a * self.size + b
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) >= PAIRS_KEPT:
                self._fits.clear()
            known = self._fits[key] = self._border_holds(a, b)
        return known

    def _border_holds(self, a: int, b: int) -> bool:
        rank, right = self.rank, self._spine(b, False)
        for x, x_from, x_until in self._spine(a, True):
            for y, y_from, y_until in right:
                # else they are never side by side
                if x_from < y_until and y_from < x_until:
                    r = rank.get(x + y)
                    # of equal merges the left one goes first
                    if r is not None and r < x_until and r <= y_until:
                        return False
        return True

    # -- one piece -----------------------------------------------------------------
    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.rank.get(piece)
        if whole is not None:
            return [whole]
        text, n = piece.decode("latin-1"), len(piece)
        token, rank, known, size = self.token, self.rank, self._fits, self.size
        matched, longest = self.trie.longest_prefix, self.longest
        dead = bytearray(n + 1)
        out: list[int] = []
        i, prev = 0, -1
        reach = matched(text[:longest])  # no token at i is longer
        while i < n:
            for length in range(reach, 0, -1):
                if dead[i + length]:
                    continue
                t = rank.get(piece[i : i + length])
                if t is None:
                    continue
                if prev < 0:
                    break
                fit = known.get(prev * size + t)
                if fit or fit is None and self.fits(prev, t):
                    break
            else:
                # out is the one valid encoding of piece[:i], so there's no other way to i
                dead[i] = 1
                if not out:
                    raise ValueError("the vocabulary lacks a byte of the text")
                reach = len(token[out.pop()]) - 1
                i -= reach + 1
                prev = out[-1] if out else -1
                continue
            out.append(t)
            i += length
            prev = t
            reach = matched(text[i : i + longest])
        return out

    def split(self, text: str) -> list[str]:
        if self.common is None or not text.isascii() and self.uncommon.search(text):
            return self.words.findall(text)
        return (self.common if "'" in text else self.plain).findall(text)

    # -- texts -----------------------------------------------------------------------
    def packer(self) -> _Pieces:
        return _Pieces(self)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class _Pieces(dict):
    """piece -> its ids as little-endian 32-bit integers, computed when first asked for.
    When it is full it becomes the older half of the memo, from which entries that are
    asked for again come back."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.tokenizer = tokenizer
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        packed = self.older.get(piece)
        if packed is None:
            ids = self.tokenizer.encode_piece(piece.encode())
            packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= 64:
            if len(self) >= PIECES_KEPT:
                self.older = dict(self)
                self.clear()
            self[piece] = packed
        return packed

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.tokenizer.split(text)))


_LOADED: dict[tuple[str, str], _Pieces] = {}


def pieces(path: str, pattern: str) -> _Pieces:
    """The worker's tokenizer; it stays loaded while Spark reuses the worker."""
    key = (path, pattern)
    if key not in _LOADED:
        _LOADED[key] = Tokenizer(path, pattern).packer()
    return _LOADED[key]


def encode_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None,
                     pattern: str | None = None) -> DataFrame:
    """Per row: key, n_tokens, ids (binary, little-endian unsigned 32-bit) and decoded
    (binary: the bytes that the ids stand for)."""
    ship(docs.sparkSession)
    path = path or public_tokenizers.path(VOCABULARY)
    pattern = pattern or public_tokenizers.PATTERN
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces(path, pattern)

        def rows():
            for batch in batches:
                for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                    ids = known.encode(t.as_py() or "")
                    yield k, len(ids) // 4, ids, known.tokenizer.decode(ids)

        yield from out_batches(rows(), schema)

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(encode, "doc_id long, n_tokens long, ids binary, decoded binary")
