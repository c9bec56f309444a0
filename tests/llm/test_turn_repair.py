"""Conversation structure repair against a row-by-row search and a full interval chart."""

import hashlib
import random
import re
import zlib

import duckdb
import pytest

from fillwise.llm import queries_structure, turn_repair

SCHEMA = "conv_id long, turn long, role string, text string, at long, edit string, Conv string"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
ROLE = {"u": "user", "a": "assistant"}


def search(rows):
    """Cheapest (cost, audit, messages) of [(kind, role, text)]: kind g good, t truncated, x to go."""
    def insert(cells):
        for _ in range(4):
            for last, (c, a, out) in list(cells.items()):
                n = NEXT[last]
                new = (c + 2, a + "I", (*out, (ROLE[n], "")))
                cells[n] = min(cells.get(n, new), new, key=lambda x: x[:2])
        return cells

    cells = insert({"": (0, "", ())})
    for kind, role, text in rows:
        new = {}
        for last, (c, a, out) in cells.items():
            more = [(last, (c + 3, a + "D", out))]
            if kind != "x":
                n = NEXT[last]
                e = kind == "t"
                if role[:1] == n or last == "" and role[:1] == "s":
                    more.append((role[:1], (c + e, a + "K", (*out, (role, text)))))
                more.append((n, (c + 2 + e, a + "R", (*out, (ROLE[n], text)))))
            for to, cell in more:
                new[to] = min(new.get(to, cell), cell, key=lambda x: x[:2])
        cells = insert(new)
    return min((cells[x] for x in ("", "a") if x in cells), key=lambda x: x[:2])


def faults(rows):
    """The kinds of ordered [(turn, role, text)] and their counts."""
    seen, kinds, n = set(), [], {"b": 0, "d": 0, "t": 0}
    for _, role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        k = "b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "g"
        if k in n:
            n[k] += 1
        seen.add((role, text))
        kinds.append(("x" if k in "bd" else k, role, text))
    return kinds, n


def expected(table):
    want = {}
    for conv in {r[0] for r in table}:
        rows = []
        for c, turn, role, text in (r[:4] for r in table if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            f = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            if f == 1:
                text = ""
            if f == 2:
                text = re.sub("[.!?]", "", text)
            rows += [(turn, "user" if f == 4 else role, text)] * (0 if f == 0 else 2 if f == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2].encode()))
        kinds, n = faults(rows)
        first = [r[1][:1] or " " for r in rows]
        turns = [r[0] for r in rows if r[0] is not None]
        cost, audit, out = search(kinds) if rows else (0, "", ())
        want[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, n["b"], n["d"], n["t"],
                      sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])), cost, audit,
                      hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())
    return want


def rows():
    rnd = random.Random(11)
    texts = ["Yes.", "Yes.", "No", "", None, " \n\t", "Well?  ", "Stop!", "x" * 4000 + ".", "é漢 🙂", "a "]
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "Users"]
    out = []
    for conv in [*range(60), None, -5]:
        for turn in range(rnd.randint(1, 9)):
            out.append((conv, rnd.choice([turn, turn, turn, turn, None, turn + 2]), rnd.choice(roles), rnd.choice(texts), 1, "K", "z"))
    out += [(100, 7, "user", "Again.", 1, "K", "z")] * 5 + [(101, None, None, None, 1, "K", "z")] * 3
    return out


def got(spark, table, monkeypatch=None):
    df = spark.createDataFrame(table, SCHEMA)
    fixed = turn_repair.repair(queries_structure.damaged(df).withColumnsRenamed({"conv_id": "id"}), key="id")
    digest = {r.conv: r.sha256 for r in turn_repair.digests(fixed.messages()).collect()}
    none = hashlib.sha256().hexdigest()
    out = {r.conv: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, digest.get(r.conv, none))
           for r in fixed.summary.collect()}
    return {c: out.get(c, (0, 0, 0, 0, 0, 0, "", none)) for c in {r[0] for r in table}}


def test_equals_row_by_row_search(spark):
    assert got(spark, rows()) == expected(rows())


def test_one_long_conversation_is_parsed_in_blocks(spark, monkeypatch):
    rnd = random.Random(5)
    table = [(1, t, rnd.choice(["user", "assistant", "assistant", "system"]), rnd.choice(["Go.", f"Text {t}.", f"Cut {t}", ""]),
              1, "K", "z") for t in range(700)] + [(2, 0, "user", "Hi.", 1, "K", "z"), (2, 1, "assistant", "Ho.", 1, "K", "z")]
    monkeypatch.setattr(turn_repair, "BLOCK_BITS", 4)
    monkeypatch.setattr(turn_repair, "JOIN", 3)
    assert got(spark, table) == expected(table)


def test_empty_table(spark):
    fixed = turn_repair.repair(spark.createDataFrame([], SCHEMA))
    assert fixed.summary.count() == fixed.messages().count() == turn_repair.digests(fixed.messages()).count() == 0


def test_messages_follow_the_pattern(spark):
    fixed = turn_repair.repair(spark.createDataFrame(rows(), SCHEMA))
    said = {}
    for r in fixed.messages().orderBy("conv", "at", "seq").collect():
        said.setdefault(r.conv, []).append(r.role[0])
    assert said and all(re.fullmatch("s?(ua)+", "".join(x)) for x in said.values())


@pytest.mark.parametrize("seed", range(30))
def test_one_split_a_span_equals_all_splits(seed):
    rnd = random.Random(seed)
    kinds = [rnd.choice("suaoSUAOx") for _ in range(rnd.randint(1, 9))]
    chart = {(i, i + 1): turn_repair.leaf(k) for i, k in enumerate(kinds)}
    for size in range(2, len(kinds) + 1):
        for i in range(len(kinds) - size + 1):
            found = [turn_repair.joined(chart[i, k], chart[k, i + size]) for k in range(i + 1, i + size)]
            assert all(f == found[0] for f in found)
            chart[i, i + size] = found[0]
    whole = turn_repair.parsed("".join(kinds))
    assert whole == chart[0, len(kinds)]
    plain = [({"x": "x"}.get(k, "t" if k.isupper() else "g"), k.lower(), "") for k in kinds]
    assert turn_repair.root(whole) == search(plain)[:2]


def test_sql_on_nulls_and_ties(spark):
    table = [r[:4] for r in rows()]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", table)
    have = {r[0]: tuple(r[1:]) for r in con.execute(queries_structure.OP11_SQL).fetchall()}
    assert have == expected(table)
