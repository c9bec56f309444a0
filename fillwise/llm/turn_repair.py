"""Conversation structure repair: weighted CYK parsing of the turns over intervals.

A conversation is to read as role initials ``(s?(ua)+)?``. Its rows are repaired by Keep
(cost 0), Rerole to user or assistant (2), Delete (3; the only edit of a blank or duplicate
row) and Insert of an empty message of user or assistant (2, anywhere); a truncated row that
stays adds 1. The repair grammar is in Chomsky normal form: a nonterminal ``[p,q]`` derives the
edited spans that lead from state p to state q (nothing yet, after s, after u, after a), with
the rules ``[p,q] -> [p,r] [r,q]``, the edits of one row as leaf rules, and insertions as
derivations of the empty span. The closure of the insertions is applied to every leaf on both
sides, so spans of any length hold them. A cell is the least (cost, audit) of its nonterminal,
audit being the initials of the edits in order. Two audits of one cell that cost the same are
never one a prefix of the other (they edit the same rows), so least cells join to least cells.
As every ``[p,q]`` splits at every border of rows, one split a span is enough: the
chart is filled bottom-up by span length, which doubles, and holds a span's 11 cells once.

Rows are ordered by (key, turn, role, text), nulls first, by a range shuffle, so that one long
conversation spreads over tasks. Blocks of at most ``BLOCK`` rows are parsed where they lie,
their charts are joined ``JOIN`` at a time until one is left of a conversation, and the audit
goes back in pieces, one a block. Only the audit of a conversation, which is a
value of the result, is ever whole in one task.

Rows: null role and text count as one space; a null key is one conversation, null turns come
first; ties are ordered by role, then text; repeated rows are duplicates of the
first. An empty role has a space as initial, which no pattern allows. An empty table gives
empty results. Only the four named columns are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fillwise.llm.common import out_batches, partitions, ship, stored

BLOCK_BITS = 10
#: Rows of a block at most.
BLOCK = 1 << BLOCK_BITS
#: Charts that are joined at once.
JOIN = 64

SPACE = " \t\n\x0b\x0c\r"

Cell = tuple[int, str]
Chart = tuple[Cell | None, ...]

#: States: nothing yet, after s, after u, after a; and what an initial does to them.
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NEXT = {0: "u", 1: "u", 2: "a", 3: "u"}
ROLE = {"u": "user", "a": "assistant"}


def _nonterminals() -> list[tuple[int, int]]:
    reach = {(p, p) for p in range(4)} | {(p, q) for (p, _), q in STEP.items()}
    while True:
        more = {(p, t) for p, q in reach for r, t in reach if q == r} | reach
        if more == reach:
            return sorted(reach)
        reach = more


NONTERMINALS = _nonterminals()
_AT = {x: i for i, x in enumerate(NONTERMINALS)}
#: For each [p,q] the pairs ([p,r], [r,q]), as places in ``NONTERMINALS``.
RULES = [[(_AT[p, r], _AT[r, q]) for r in range(4) if (p, r) in _AT and (r, q) in _AT] for p, q in NONTERMINALS]
#: The whole conversation: nothing at all, or ending after an answer.
ROOTS = (_AT[0, 0], _AT[0, 3])


def joined(left: Chart, right: Chart) -> Chart:
    """The cells of a span from those of its two parts."""
    out = []
    for rule in RULES:
        best = None
        for i, j in rule:
            a, b = left[i], right[j]
            if a is not None and b is not None:
                cell = (a[0] + b[0], a[1] + b[1])
                if best is None or cell < best:
                    best = cell
        out.append(best)
    return tuple(out)


def _insertions() -> Chart:
    """The cells of the empty span: the closure of inserting."""
    cells: list[Cell | None] = [(0, "") if p == q else None for p, q in NONTERMINALS]
    for p, q in NONTERMINALS:
        if STEP.get((p, NEXT[p])) == q:
            cells[_AT[p, q]] = (2, "I")
    while (more := joined(tuple(cells), tuple(cells))) != tuple(cells):
        cells = list(more)
    return tuple(cells)


EMPTY = _insertions()


@lru_cache(None)
def leaf(kind: str) -> Chart:
    """The cells of one row. kind: its initial s, u, a, or o for any other; in capitals if it
    is truncated; x if it must go."""
    cells: list[Cell | None] = [None] * len(NONTERMINALS)

    def put(p: int, q: int, cell: Cell) -> None:
        i = _AT[p, q]
        if cells[i] is None or cell < cells[i]:
            cells[i] = cell

    for p in range(4):
        put(p, p, (3, "D"))
        if kind != "x":
            extra = int(kind.isupper())
            if (q := STEP.get((p, kind.lower()))) is not None:
                put(p, q, (extra, "K"))
            put(p, STEP[p, NEXT[p]], (2 + extra, "R"))
    return joined(joined(EMPTY, tuple(cells)), EMPTY)


def folded(charts: list[Chart]) -> Chart:
    """The chart of adjacent spans, bottom-up: the length of the spans doubles."""
    while len(charts) > 1:
        charts = [joined(*charts[i : i + 2]) if i + 1 < len(charts) else charts[i] for i in range(0, len(charts), 2)]
    return charts[0] if charts else EMPTY


@lru_cache(4096)
def _parsed_short(kinds: str) -> Chart:
    return folded([leaf(k) for k in kinds])


def parsed(kinds: str) -> Chart:
    """The chart of a run of rows."""
    return _parsed_short(kinds) if len(kinds) <= 16 else folded([leaf(k) for k in kinds])


def root(chart: Chart) -> Cell:
    return min(chart[i] for i in ROOTS)


def pieces(audit: str, sizes: list[int]) -> Iterator[tuple[str, int]]:
    """An audit cut after every ``sizes`` rows, with the state in which each piece begins.
    Insertions before the first row are in the first piece, others with the row before them."""
    system = sum(c != "D" for c in audit) % 2 == 1  # an odd count of messages begins with s
    state, at = 0, 0
    for n in sizes:
        begin, first, rows = at, state, 0
        while at < len(audit) and (rows < n or audit[at] == "I"):
            c = audit[at]
            rows += c != "I"
            if c != "D":
                state = 1 if state == 0 and system else STEP[state, NEXT[state]]
            at += 1
        yield audit[begin:at], first


def edits_of(piece: str, state: int, kinds: str) -> Iterator[tuple[str, str | None, list[str], list[str]]]:
    """Per row: its edit, its new role if it gets one, and the roles inserted before and after."""
    rows: list[tuple[str, str | None, list[str], list[str]]] = []
    before: list[str] = []
    for c in piece:
        role = ROLE[NEXT[state]]
        if c == "I":
            (rows[-1][3] if rows else before).append(role)
        else:
            rows.append((c, role if c == "R" else None, before if not rows else [], []))
        if c == "K":
            state = STEP[state, kinds[len(rows) - 1].lower()]
        elif c != "D":
            state = STEP[state, NEXT[state]]
    return iter(rows)


@dataclass
class Repair:
    """``rows``: conv, at (place in order), turn, role, text. ``edits``: at, edit, role (new),
    before, after. ``summary``: conv, gaps, blank, duplicate, truncated, illegal, cost, audit."""
    rows: DataFrame
    edits: DataFrame
    summary: DataFrame

    def messages(self) -> DataFrame:
        """The repaired messages: conv, at, seq, edit, role, text; in order of (at, seq)."""
        def made(roles: str) -> Column:
            return F.transform(roles, lambda r: F.struct(F.lit("I").alias("edit"), r.alias("role"), F.lit("").alias("text")))

        both = self.rows.join(self.edits.withColumnRenamed("role", "new_role"), "at")
        own = F.struct("edit", F.coalesce("new_role", "role").alias("role"), "text")
        row = F.when(F.col("edit") != "D", F.array(own)).otherwise(F.array().cast(
            "array<struct<edit:string,role:string,text:string>>"))
        return (both.select("conv", "at", F.posexplode(F.concat(made("before"), row, made("after"))).alias("seq", "_m"))
                .select("conv", "at", "seq", "_m.edit", "_m.role", "_m.text"))


def repair(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> Repair:
    spark = conversations.sparkSession
    ship(spark)
    space = F.lit(" ")
    rows = conversations.select(
        F.col(key).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), space).alias("role"),
        F.coalesce(F.col(text), space).alias("text"), F.monotonically_increasing_id().alias("_read"))
    order = ["conv", "turn", "role", "text", "_read"]
    rows = stored(rows.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
                  .select("conv", F.monotonically_increasing_id().alias("at"), "turn", "role", "text"))
    marked = stored(_marked(rows))
    blocks = stored(_blocks(marked))
    whole = stored(_whole(blocks))
    best = F.least(*[F.struct(F.col("costs")[i].alias("cost"), F.col("audits")[i].alias("audit")) for i in ROOTS])
    roots = whole.select("conv", "illegal", best["cost"].alias("cost"), best["audit"].alias("audit"))
    counts = marked.groupBy("conv").agg(
        *[F.sum(F.col(c).cast("long")).alias(c) for c in ("blank", "duplicate", "truncated")],
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"))
    summary = one_row_each("conv", counts, roots)
    return Repair(rows, stored(_edits(blocks, whole)), summary)


def one_row_each(key: str, *parts: DataFrame) -> DataFrame:
    """Tables of at most one row a key side by side; a null key is a key."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.groupBy(key).agg(*[F.max(c).alias(c) for c in out.columns if c != key])


def _marked(rows: DataFrame) -> DataFrame:
    """The faults and the kind of each row, without its text."""
    conv = F.col("conv").cast("string")
    same = F.unhex(F.sha2(F.concat(  # lengths first: no two rows that differ spell the same
        F.coalesce(F.concat(F.length(conv), F.lit("="), conv), F.lit("-")), F.lit(":"),
        F.length("role"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256))
    body = F.rtrim("text", F.lit(SPACE))
    narrow = rows.select("conv", "at", "turn", F.rpad(F.substring("role", 1, 1), 1, " ").alias("initial"),
                         (body == "").alias("blank"), (~F.substring(body, -1, 1).isin(".", "!", "?")).alias("open"),
                         same.alias("same"))
    first = narrow.groupBy("same").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    x = narrow.join(first.select("same", "first"), "same", "left")
    x = x.withColumn("duplicate", ~F.col("blank") & F.coalesce(F.col("at") > F.col("first"), F.lit(False)))
    x = x.withColumn("truncated", ~F.col("blank") & ~F.col("duplicate") & F.col("open"))
    known = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    kind = F.when(F.col("blank") | F.col("duplicate"), "x").when(F.col("truncated"), F.upper(known)).otherwise(known)
    return x.select("conv", "at", "turn", "initial", "blank", "duplicate", "truncated", kind.alias("kind"))


def _runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[list[dict]]:
    """Rows of equal keys that follow each other."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and any(held[-1][k] != row[k] for k in keys):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _breaks(initials: str) -> int:
    """Neighbours that no conversation may have."""
    return sum(initials[i : i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1))


_CHART = [("illegal", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("costs", pa.list_(pa.int64())),
          ("audits", pa.list_(pa.string()))]
_CHART_SQL = "illegal long, first string, last string, costs array<long>, audits array<string>"


def _columns(chart: Chart) -> tuple[list, list]:
    return [c and c[0] for c in chart], [c and c[1] for c in chart]


def _chart(row: dict) -> Chart:
    return tuple(None if a is None else (c, a) for c, a in zip(row["costs"], row["audits"]))


def _weight(row: tuple) -> int:
    return sum(sum(len(x) if isinstance(x, str) else 8 for x in v if x is not None) if isinstance(v, list)
               else len(v) if isinstance(v, str) else 8 for v in row)


def _mapped(df: DataFrame, work, fields: list[tuple[str, pa.DataType]], sql: str) -> DataFrame:
    """``work`` over the rows of each task; the column ``conv`` keeps its type."""
    conv = df.schema["conv"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        head = next(batches, None)
        if head is None:
            return
        kind = head.schema.field("conv").type

        def every() -> Iterator[pa.RecordBatch]:
            yield head
            yield from batches

        yield from out_batches(work(every()), pa.schema([("conv", kind), *fields]), _weight)

    return df.mapInArrow(run, StructType([conv, *StructType.fromDDL(sql).fields]))


def _blocks(marked: DataFrame) -> DataFrame:
    """A chart for each block: conv, block (its first place), ats, kinds, the chart's columns."""
    def work(batches):
        for rows in _runs(batches, ["conv", "slot"]):
            kinds, initials = ("".join(r[c] for r in rows) for c in ("kind", "initial"))
            yield (rows[0]["conv"], rows[0]["at"], [r["at"] for r in rows], kinds, _breaks(initials), initials[0], initials[-1],
                   *_columns(parsed(kinds)))

    dealt = (marked.select("conv", "at", "kind", "initial", F.shiftright("at", BLOCK_BITS).alias("slot"))
             .repartition("conv", "slot").sortWithinPartitions("conv", "at"))
    fields = [("block", pa.int64()), ("ats", pa.list_(pa.int64())), ("kinds", pa.string()), *_CHART]
    return _mapped(dealt, work, fields, f"block long, ats array<long>, kinds string, {_CHART_SQL}")


def _whole(blocks: DataFrame) -> DataFrame:
    """The chart of each conversation, with its blocks and their sizes in order."""
    def work(batches):
        for rows in _runs(batches, ["conv", "slot"]):
            illegal = sum(r["illegal"] for r in rows) + sum(
                _breaks(a["last"] + b["first"]) for a, b in zip(rows, rows[1:]))
            yield (rows[0]["conv"], rows[0]["slot"], [b for r in rows for b in r["blocks"]], [n for r in rows for n in r["sizes"]],
                   illegal, rows[0]["first"], rows[-1]["last"], *_columns(folded([_chart(r) for r in rows])))

    fields = [("i", pa.int64()), ("blocks", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), *_CHART]
    place = F.row_number().over(Window.partitionBy("conv").orderBy("block")) - 1
    level = blocks.select("conv", place.cast("long").alias("i"), F.array("block").alias("blocks"),
                          F.array(F.size("ats").cast("long")).alias("sizes"), *[n for n, _ in _CHART])
    most = (blocks.groupBy("conv").count().agg(F.max("count")).first()[0] or 1)
    while True:
        dealt = (level.withColumn("slot", F.floor(F.col("i") / JOIN)).repartition("conv", "slot")
                 .sortWithinPartitions("conv", "i"))
        level = _mapped(dealt, work, fields, f"i long, blocks array<long>, sizes array<long>, {_CHART_SQL}")
        most = -(-most // JOIN)
        if most == 1:
            return level
        level = stored(level)


def _edits(blocks: DataFrame, whole: DataFrame) -> DataFrame:
    def cut(batches):
        for batch in batches:
            for r in batch.to_pylist():
                found = pieces(root(_chart(r))[1], r["sizes"])
                for b, (piece, state) in zip(r["blocks"], found):
                    yield r["conv"], b, piece, state

    sent = _mapped(whole.select("conv", "blocks", "sizes", "costs", "audits"), cut,
                   [("block", pa.int64()), ("piece", pa.string()), ("state", pa.int64())],
                   "block long, piece string, state long").drop("conv")

    def spread(batches):
        for batch in batches:
            for r in batch.to_pylist():
                for at, e in zip(r["ats"], edits_of(r["piece"], r["state"], r["kinds"])):
                    yield r["conv"], at, *e

    lists = pa.list_(pa.string())
    both = blocks.select("conv", "block", "ats", "kinds").join(sent, "block")
    return _mapped(both, spread, [("at", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("before", lists), ("after", lists)],
                   "at long, edit string, role string, before array<string>, after array<string>").drop("conv")


def digests(messages: DataFrame) -> DataFrame:
    """sha256 of each conversation's ``role:text`` lines. The digest of one conversation is
    sequential, so its rows stream through one task, sorted; none are held."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, now, kind = None, None, None
        done: list[tuple] = []

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], kind), pa.array([h for _, h in done])],
                                             ["conv", "sha256"])
            done.clear()
            return out

        for batch in batches:
            kind = batch.schema.field("conv").type
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "role", "text"))):
                if state is None or conv != now:
                    if state is not None:
                        done.append((now, state.hexdigest()))
                    state, now = hashlib.sha256(), conv
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            if len(done) > 10_000:
                yield flush()
        if state is not None:
            done.append((now, state.hexdigest()))
            yield flush()

    ship(messages.sparkSession)
    dealt = messages.select("conv", "at", "seq", "role", "text").repartition("conv").sortWithinPartitions("conv", "at", "seq")
    return dealt.mapInArrow(run, StructType([messages.schema["conv"], StructField("sha256", StringType())]))
