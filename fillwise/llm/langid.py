"""Language identification by segmentation-marginalised unigrams.

Each language has probabilities of the pieces of a fixed public vocabulary. A word's
probability in a language is the sum over all its segmentations into pieces, by the forward
algorithm; a text's is the product over its words (lower-cased runs of letters). The piece
probabilities are learned by expectation maximisation: expected piece counts over all
segmentations (forward-backward) of the words of a bounded, hashed sample of labelled texts,
summed by task. A word's vector of log probabilities is memoised in the worker; words that
are new to it are taken through the forward algorithm together, all languages at once.

Rows: null texts and texts without a letter get ``und`` and score 0, as does everything when
nothing was learned; ties go to the language first by code point. Null or repeated ids are
scored like any others; rows with a null language teach nothing. The score is the
posterior of the predicted language under equal priors.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from fillwise.llm.common import out_batches, ship, stored

VOCABULARY = "piece_bpe_32k.model"
#: Labelled texts that teach at most, rounds of expectation maximisation, and tasks that sum.
TRAIN_DOCS = 8_000
ROUNDS = 4
SUM_TASKS = 6
#: Weight of the pooled distribution in each language's, and the probability of a character
#: outside the vocabulary.
POOLED = 2_000.0
UNKNOWN = 1e-7
#: Longer words carry an exponent beside each number, as their probabilities leave a double's range.
PLAIN_CHARS = 32
#: Words and characters that go through the vocabulary's graph together, and characters that a memo holds.
WORDS_AT_ONCE, CHARS_AT_ONCE = 5_000, 160_000
CHARS_KEPT = 12_000_000
WORDS_KEPT = 700_000
UND = "und"
START = "▁"
WORD = re.compile(r"[^\W\d_]+")


class Lattice:
    """The vocabulary's trie, and words as graphs of pieces."""

    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
                  if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        pieces = sorted({p for p in pieces if "\n" not in p})
        self.size = len(pieces)
        self.length = np.array([*map(len, pieces), 1])  # the last one: any other character
        self.trie = ahocorasick.Automaton()
        for i, p in enumerate(pieces):
            self.trie.add_word(p, i)
        self.trie.make_automaton()

    def edges(self, words: list[str]):
        """(first node of each word, characters of each, and by edge: from, to, piece), nodes
        being positions in the words written one after another."""
        text = "\n".join(START + w for w in words) + "\n"
        size = np.fromiter(map(len, words), np.int64, len(words)) + 1
        first = np.cumsum(size + 1) - (size + 1)
        hits = np.array([x for hit in self.trie.iter(text) for x in hit], np.int64).reshape(-1, 2)
        chars = np.delete(np.arange(len(text)), first + size)
        stop = np.concatenate([hits[:, 0], chars]) + 1
        piece = np.concatenate([hits[:, 1], np.full(len(chars), self.size)])
        return first, size, stop - self.length[piece], stop, piece

    def forward(self, words: list[str], p: np.ndarray) -> np.ndarray:
        """log of the sum over all segmentations: words x languages. ``p``: pieces x languages."""
        out = np.zeros((len(words), p.shape[1]))
        for at, long in portions(words):
            first, size, a, b, piece = self.edges([words[i] for i in at])
            alpha, power = (self._scaled if long else self._sweep)(first, size, a, b, piece, p, False)
            out[at] = np.log(alpha[first + size]) + (power[first + size] * np.log(2) if long else 0.0)
        return out

    @staticmethod
    def _steps(first, a, b, back: bool):
        """(edges, from, to, first edge of each target) of all words, position after position."""
        owner_first = first[np.searchsorted(first, a, "right") - 1]
        step = (a if back else b) - owner_first
        order = np.lexsort((a if back else b, -step if back else step))
        s = step[order]
        cut = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1], [True]]))
        for i, j in zip(cut, cut[1:]):
            e = order[i:j]
            src, dst = (b[e], a[e]) if back else (a[e], b[e])
            yield e, src, dst, np.flatnonzero(np.concatenate([[True], dst[1:] != dst[:-1]]))

    def _sweep(self, first, size, a, b, piece, p, back: bool) -> tuple[np.ndarray, None]:
        value = np.zeros((int(first[-1] + size[-1]) + 2, p.shape[1]))
        value[first + size if back else first] = 1
        for e, src, dst, head in self._steps(first, a, b, back):
            value[dst[head]] = np.add.reduceat(value[src] * p[piece[e]], head, axis=0)
        return value, None

    def _scaled(self, first, size, a, b, piece, p, back: bool) -> tuple[np.ndarray, np.ndarray]:
        """As ``_sweep``, each number being value * 2 ** power, so that words of any length fit."""
        value = np.zeros((int(first[-1] + size[-1]) + 2, p.shape[1]))
        power = np.zeros(value.shape, np.int64)
        value[first + size if back else first] = 1
        for e, src, dst, head in self._steps(first, a, b, back):
            most = np.maximum.reduceat(power[src], head, axis=0)
            below = power[src] - np.repeat(most, np.diff(np.append(head, len(dst))), axis=0)
            part = np.ldexp(value[src] * p[piece[e]], np.maximum(below, -4000).astype(np.int32))
            value[dst[head]], up = np.frexp(np.add.reduceat(part, head, axis=0))
            power[dst[head]] = most + up
        return value, power

    def expected(self, words: list[str], counts: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Expected uses of each piece, pieces x languages. ``counts``: words x languages."""
        total = np.zeros((self.size + 1, p.shape[1]))
        for at, long in portions(words):
            first, size, a, b, piece = self.edges([words[i] for i in at])
            sweep = self._scaled if long else self._sweep
            alpha, ahead = sweep(first, size, a, b, piece, p, False)
            beta, behind = sweep(first, size, a, b, piece, p, True)
            word = np.searchsorted(first, a, "right") - 1
            weight = counts[at] / alpha[first + size]
            use = alpha[a] * p[piece] * beta[b] * weight[word]
            if long:
                use = np.ldexp(use, np.maximum(ahead[a] + behind[b] - ahead[first + size][word], -4000).astype(np.int32))
            total += np.stack([np.bincount(piece, use[:, k], self.size + 1) for k in range(p.shape[1])], 1)
        return total


def portions(words: list[str]) -> Iterator[tuple[np.ndarray, bool]]:
    """(places, whether long) of words that are taken together; a longer word than fits is alone."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    for long in (False, True):
        at = np.flatnonzero((size > PLAIN_CHARS) == long)
        room = np.cumsum(size[at]) // CHARS_AT_ONCE
        new = np.concatenate([[0], np.flatnonzero(np.diff(room)) + 1, [len(at)]]) if len(at) else np.zeros(1, int)
        for i, j in zip(new, new[1:]):
            for k in range(i, j, WORDS_AT_ONCE):
                yield at[k : min(j, k + WORDS_AT_ONCE)], long


@dataclass
class Model:
    path: str
    languages: list[str]
    p: np.ndarray
    key: int


_LATTICES: dict[str, Lattice] = {}
_MEMOS: dict = {}


def lattice(path: str) -> Lattice:
    if path not in _LATTICES:
        _LATTICES[path] = Lattice(path)
    return _LATTICES[path]


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


class _Memo(dict):
    """word -> row of its log probabilities; new words get a row that is filled in later."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.lattice = model, lattice(model.path)
        self.rows = np.zeros((1024, len(model.languages)))
        self.new: list[str] = []
        self.chars = 0

    def __missing__(self, word: str) -> int:
        self[word] = i = len(self)
        self.new.append(word)
        self.chars += len(word)
        return i

    def fill(self) -> None:
        if self.new:
            at = len(self) - len(self.new)
            while len(self.rows) < len(self):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[at : at + len(self.new)] = self.lattice.forward(self.new, self.model.p)
            self.new = []

    def texts(self, texts: list[str]) -> np.ndarray:
        """Log probability of each text in each language."""
        if len(self) > WORDS_KEPT or self.chars > CHARS_KEPT:
            self.clear()
            self.chars = 0
        found = [list(map(self.__getitem__, words_of(t))) for t in texts]
        self.fill()
        out = np.zeros((len(texts), self.rows.shape[1]))
        for i, ids in enumerate(found):
            if ids:
                out[i] = self.rows[ids].sum(0)
        return out


def held_out(key: str, folds: int, of: int):
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds == of


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", path: str | None = None,
        train_docs: int = TRAIN_DOCS) -> Model:
    """Learn from the labelled rows of ``docs``."""
    ship(docs.sparkSession)
    path = path or public_tokenizers.path(VOCABULARY)
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = {r[0]: r[1] for r in labelled.groupBy(lang).count().collect()}  # a row per language
    languages = sorted(sizes, key=lambda x: [ord(c) for c in x])
    if not languages:
        return Model(path, [], np.zeros((0, 0)), 0)
    # an equal share of the sample for each language, by a hash of the id
    share = train_docs / len(languages)
    chance = F.coalesce(*[F.when(F.col(lang) == x, F.lit(min(1.0, share / sizes[x]))) for x in languages])
    sample = labelled.where(F.pmod(F.xxhash64(F.col(key), F.lit(3)), F.lit(1 << 20)) < chance * (1 << 20))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("uses", pa.int64())])
        for batch in batches:
            uses: dict[str, Counter] = {}
            for x, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                uses.setdefault(x, Counter()).update(words_of(t))
            yield from out_batches(((x, w, n) for x, c in uses.items() for w, n in c.items()), schema)

    k = len(languages)
    by_lang = [F.sum(F.when(F.col("lang") == x, F.col("uses")).otherwise(0)).cast("double") for x in languages]
    counts = stored(sample.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
                    .mapInArrow(count, "lang string, word string, uses long")
                    .groupBy("word").agg(F.array(*by_lang).alias("uses")).repartition(SUM_TASKS, "word"))
    v = lattice(path).size + 1
    p = np.full((v, k), 1.0 / v)
    p[-1] = UNKNOWN
    for _ in range(ROUNDS):
        q = p

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            net, total = lattice(path), np.zeros((v, k))
            for batch in batches:
                words = batch.column(0).to_pylist()
                uses = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
                total += net.expected(words, uses, q)
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["sums"])

        total = np.zeros((v, k))
        for r in counts.mapInArrow(expect, "sums binary").collect():
            total += np.frombuffer(r["sums"]).reshape(v, k)
        pooled = total[:-1].sum(1) + 0.5
        pooled /= pooled.sum()
        p = np.empty((v, k))
        p[:-1] = (total[:-1] + POOLED * pooled[:, None]) / (total[:-1].sum(0) + POOLED)
        p[-1] = UNKNOWN
    return Model(path, languages, p, hash(p.tobytes()))


def identified(docs: DataFrame, model: Model, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its posterior; other columns pass through."""
    ship(docs.sparkSession)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model.key not in _MEMOS:
            _MEMOS.clear()
            _MEMOS[model.key] = _Memo(model)
        memo = _MEMOS[model.key]
        for whole in batches:
            for i in range(0, whole.num_rows, 500):
                batch = whole.slice(i, 500)
                texts = [t or "" for t in batch.column(at).to_pylist()]
                some = np.array([bool(model.languages) and any(map(str.isalpha, t)) for t in texts], bool)
                names, scores = [UND] * len(texts), np.zeros(len(texts))
                if some.any():
                    logs = memo.texts([t if ok else "" for t, ok in zip(texts, some)])
                    best = logs.argmax(1)
                    scores = np.where(some, 1 / np.exp(logs - logs.max(1, keepdims=True)).sum(1), 0.0)
                    names = [model.languages[b] if ok else UND for b, ok in zip(best, some)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names), pa.array(scores)],
                                                 [*batch.schema.names, lang, score])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(lang, StringType()), StructField(score, DoubleType())]))
