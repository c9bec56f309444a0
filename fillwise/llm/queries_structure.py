"""Registered queries of the operators on structure, phrases and statistics (11 to 13):
thin calls with production parameters over whole tables, and their DuckDB SQL."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fillwise.llm import collocations, robust_outliers, turn_repair
from fillwise.llm.common import table

NO_BYTES = hashlib.sha256().hexdigest()


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows of ``conversations`` with planted faults, by crc32 of ``conv_id:turn`` mod 20: 0 drops
    the row, 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes it the user's."""
    conv, turn, role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text"))
    fault = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    copies = F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1)
    return (conversations.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.sequence(F.lit(1), F.lit(2))).alias("_copy"), copies.alias("_copies"))
        .where("_copy <= _copies").drop("_copy", "_copies"))


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and digest of the repaired messages of every conversation."""
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    fixed = turn_repair.repair(damaged(conversations))
    every = conversations.groupBy(F.col("conv_id").alias("conv")).agg(F.lit(1).alias("_one"))
    out = turn_repair.one_row_each("conv", every, fixed.summary, turn_repair.digests(fixed.messages()))
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in
              ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(F.col("conv").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("sha256", F.lit(NO_BYTES)).alias("repaired_sha256"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of two or three words of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the quality rules for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return robust_outliers.judged(docs).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def _crc32(text: str) -> str:
    """SQL: crc32 of an ASCII string, bit by bit."""
    bits = "list_reduce(range(8), lambda c, k: xor(c >> 1, 3988292384 * (c & 1)), xor(crc, byte))"
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: ascii(substr({text}, i, 1))::BIGINT)"
    return f"xor(4294967295, list_reduce({codes}, lambda crc, byte: {bits}, 4294967295::BIGINT))"


def _then(cell: str, cost: str, edit: str, message: str = "''") -> str:
    """SQL: a cell {k: cost in 9 digits and audit, o: messages} after one more edit; null stays null."""
    return (f"CASE WHEN {cell} IS NOT NULL THEN {{'k': lpad((left({cell}.k, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || substr({cell}.k, 10) || '{edit}', "
            f"'o': {cell}.o || {message}}} END")


def _least(*cells: str) -> str:
    return f"list_sort(list_filter([{', '.join(cells)}], lambda x: x IS NOT NULL))[1]"


_KEPT, _USER, _BOT = "chr(10) || role || ':' || text", "chr(10) || 'user:' || text", "chr(10) || 'assistant:' || text"
_NEW_USER, _NEW_BOT = "chr(10) || 'user:'", "chr(10) || 'assistant:'"


def _stays(initial: str, cells: list[str], message: str) -> list[str]:
    kept = [f"CASE WHEN fault NOT IN ('blank', 'duplicate') AND initial = '{initial}' THEN {_then(c, 'more', 'K', _KEPT)} END" for c in cells]
    return kept + [f"CASE WHEN fault NOT IN ('blank', 'duplicate') THEN {_then(c, '2 + more', 'R', message)} END" for c in cells if message]


# row by row, not over spans: cells of the states nothing yet, after s, after u, after a
OP11_SQL = f"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
f AS (SELECT *, {_crc32('key')} % 20 AS f FROM k),
d AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
             CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(range(CASE f WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM f),
p AS (SELECT *, regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS body, left(role, 1) AS initial,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM d),
r AS MATERIALIZED (SELECT *, i - min(i) OVER (PARTITION BY conv_id, role, text) AS later FROM p),
m AS MATERIALIZED (SELECT *, CASE WHEN body = '' THEN 'blank' WHEN later > 0 THEN 'duplicate'
                     WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'fine' END AS fault,
             CASE WHEN body <> '' AND later = 0 AND right(body, 1) NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS more,
             lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM r),
walk(conv_id, i, c0, c1, c2, c3) AS (
  SELECT conv_id, 0::BIGINT, {{'k': '000000000', 'o': ''}}, NULL::STRUCT(k VARCHAR, o VARCHAR),
         {{'k': '000000002I', 'o': {_NEW_USER}}}, {{'k': '000000004II', 'o': {_NEW_USER} || {_NEW_BOT}}}
  FROM (SELECT DISTINCT conv_id FROM m)
  UNION ALL
  SELECT conv_id, i, n0, n1, n2, {_least('n3', _then('n2', '2', 'I', _NEW_BOT))}
  FROM (SELECT conv_id, i, n0, n1, n3, {_least('n2', *[_then(c, '2', 'I', _NEW_USER) for c in ('n0', 'n1', 'n3')])} AS n2
    FROM (SELECT w.conv_id, m.i, {_then('c0', '3', 'D')} AS n0,
                 {_least(_then('c1', '3', 'D'), *_stays('s', ['c0'], ''))} AS n1,
                 {_least(_then('c2', '3', 'D'), *_stays('u', ['c0', 'c1', 'c3'], _USER))} AS n2,
                 {_least(_then('c3', '3', 'D'), *_stays('a', ['c2'], _BOT))} AS n3
          FROM walk w JOIN m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.i = w.i + 1))),
n AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
             count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
      FROM m GROUP BY conv_id),
b AS (SELECT conv_id, i, {_least('c0', 'c3')} AS best FROM walk)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
       coalesce(left(best.k, 9), '0')::BIGINT AS cost, coalesce(substr(best.k, 10), '') AS audit,
       sha256(coalesce(substr(best.o, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM c.conv_id AND b.i = n.n
"""

# a phrase is its words joined by one space, which no word holds
OP12_SQL = f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
           FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
t AS (SELECT lang, unnest(w) AS a, unnest(w[2 :]) AS b, unnest(w[3 :]) AS c FROM w),
f1 AS (SELECT lang, a, count(*) AS f FROM t GROUP BY lang, a),
f2 AS (SELECT lang, a, b, count(*) AS f FROM t WHERE b IS NOT NULL GROUP BY lang, a, b HAVING count(*) >= {collocations.MIN_COUNT}),
f3 AS (SELECT lang, a, b, c, count(*) AS f FROM t WHERE c IS NOT NULL GROUP BY lang, a, b, c HAVING count(*) >= {collocations.MIN_COUNT}),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang),
o AS (SELECT lang, a, b, max(f) AS f FROM (SELECT lang, a, b, f FROM f3 UNION ALL SELECT lang, b, c, f FROM f3) GROUP BY lang, a, b),
s AS (SELECT p.lang, p.a || ' ' || p.b AS phrase, p.f AS a, x.f AS l, y.f AS r, 1 AS k
      FROM f2 p JOIN f1 x ON x.lang = p.lang AND x.a = p.a JOIN f1 y ON y.lang = p.lang AND y.a = p.b
      LEFT JOIN o ON o.lang = p.lang AND o.a = p.a AND o.b = p.b
      WHERE o.f IS NULL OR 100 * o.f < {collocations.INSIDE} * p.f
      UNION ALL
      SELECT p.lang, p.a || ' ' || p.b || ' ' || p.c, p.f, x.f, y.f, 1
      FROM f3 p JOIN f1 x ON x.lang = p.lang AND x.a = p.a JOIN f2 y ON y.lang = p.lang AND y.a = p.b AND y.b = p.c
      UNION ALL
      SELECT p.lang, p.a || ' ' || p.b || ' ' || p.c, p.f, x.f, y.f, 2
      FROM f3 p JOIN f2 x ON x.lang = p.lang AND x.a = p.a AND x.b = p.b JOIN f1 y ON y.lang = p.lang AND y.a = p.c),
z AS (SELECT *, ({collocations.SCALE}::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM s),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM z) WHERE o = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b) JOIN n USING (lang)
WHERE rank <= {collocations.TOP}
"""

QUERIES = {"op11_turn_repair": op11_turn_repair, "op12_collocations": op12_collocations,
           "op13_robust_outliers": op13_robust_outliers}
ORACLES: dict[str, str] = {"op11_turn_repair": OP11_SQL, "op12_collocations": OP12_SQL}
