"""Quotation linking: who answers whom in a conversation, from the passages they quote.

A message's lines are parsed into its own text and quoted passages (runs of lines with the
same number of leading ``>``; a line that only introduces a quotation goes with it). Passages
are normalised (lower case, white space as one space) and hashed: a quoted passage, its
paragraphs and its lines, and likewise every message's own text. The hashes meet in a join
within the conversation; a passage's original is the first message that has it as its own
text, and a message answers the original of its first linked quotation of the outermost
level (of a deeper level, if none of that is linked). Originals are earlier messages, so answers
form trees; their roots and depths come from pointer jumping, a join a round. Ordered by
(conv_id, thread, turn), every answer follows what it answers, and messages without links keep
their turn.

A frequent passage or a conversation that holds most messages meets only min-aggregations
and joins against one row a key, never a group in one task.

Rows: null or empty texts have no own text and quote nothing; null conv_id or turn link with
nothing (thread is the own turn); rows that repeat a (conv_id, turn) are each returned, and
count as one message when linked to. ``text`` is the message without quotations.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillwise.llm.common import out_batches, ship, stored

MARK = re.compile(r"[ \t]*((?:>[ \t]?)+)(.*)", re.S)
#: Lines that introduce a quotation.
INTRODUCES = re.compile(r".*\b(wrote|writes|said|schrieb|escribió|écrit)\s*:\s*", re.I)


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def digest(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def parsed(text: str) -> tuple[str, list[tuple[int, str]]]:
    """(own text, [(level, quoted passage)] in order)."""
    lines: list[tuple[int, str]] = []
    for line in text.split("\n"):
        m = MARK.match(line)
        lines.append((m[1].count(">"), m[2]) if m else (0, line))
    own: list[str] = []
    quoted: list[tuple[int, list[str]]] = []
    for i, (level, line) in enumerate(lines):
        after = next((x[0] for x in lines[i + 1 :] if x[1].strip()), level) if INTRODUCES.fullmatch(line) else level
        if after > level:
            continue
        if level == 0:
            own.append(line)
        elif i and quoted and lines[i - 1][0] == level:
            quoted[-1][1].append(line)
        else:
            quoted.append((level, [line]))
    return "\n".join(own).strip(), [(k, "\n".join(p).strip()) for k, p in quoted if "".join(p).strip()]


def passages(text: str) -> list[str]:
    """The text, its paragraphs and its lines, normalised, longest units first."""
    out = [normal(text)]
    out += [normal(p) for p in re.split(r"\n\s*\n", text)]
    out += [normal(line) for line in text.split("\n")]
    return list(dict.fromkeys(x for x in out if x))


def link(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Per message: conv_id, turn, role, text, parent_turn, thread, depth, n_quotes, n_linked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()),
                            ("own", pa.list_(pa.int64())), ("levels", pa.list_(pa.int32())), ("quotes", pa.list_(pa.list_(pa.int64())))])

        def rows():
            for batch in batches:
                for c, t, r, x in zip(*(col.to_pylist() for col in batch.columns)):
                    own, quoted = parsed(x or "")
                    yield (c, t, r, own, [digest(p) for p in passages(own)], [k for k, _ in quoted],
                           [[digest(p) for p in passages(q)] for _, q in quoted])

        yield from out_batches(rows(), schema, lambda row: 64 + len(row[3]) + 8 * len(row[4]))

    ship(messages.sparkSession)
    plain = messages.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                            F.col(role).cast("string").alias("role"), F.col(text).alias("text"))
    read = stored(plain.mapInArrow(run, "conv_id long, turn long, role string, text string, own array<long>, "
                                        "levels array<int>, quotes array<array<long>>"))
    originals = (read.where(F.col("turn").isNotNull()).select("conv_id", "turn", F.explode("own").alias("h"))
                 .groupBy("conv_id", "h").agg(F.min("turn").alias("original")))
    asked = (read.where(F.size("levels") > 0)
             .select("conv_id", "turn", "levels", F.posexplode("quotes").alias("place", "hashes"))
             .select("conv_id", "turn", F.col("place"), F.element_at("levels", F.col("place") + 1).alias("level"),
                     F.posexplode("hashes").alias("unit", "h")))
    hits = (asked.join(originals, ["conv_id", "h"]).where(F.col("original") < F.col("turn"))
            .groupBy("conv_id", "turn")
            .agg(F.min(F.struct("level", "place", "unit", "original"))["original"].alias("parent_turn"),
                 F.count_distinct("place").alias("n_linked")))
    hits = stored(hits)

    # roots and depths by pointer jumping over linked messages
    up = hits.select("conv_id", "turn", F.col("parent_turn").alias("root"), F.lit(1).cast("long").alias("depth"))
    while True:
        above = up.select(F.col("conv_id"), F.col("turn").alias("root"), F.col("root").alias("higher"), F.col("depth").alias("more"))
        new = stored(up.join(above, ["conv_id", "root"], "left").select(
            "conv_id", "turn", F.coalesce("higher", "root").alias("root"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("higher").isNotNull().alias("moved")))
        up = new.drop("moved")
        if new.where("moved").limit(1).count() == 0:
            break
    return (read.join(hits, ["conv_id", "turn"], "left").join(up, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", "text", "parent_turn", F.coalesce("root", "turn").alias("thread"),
        F.coalesce("depth", F.lit(0)).alias("depth"), F.size("levels").cast("long").alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).alias("n_linked")))
