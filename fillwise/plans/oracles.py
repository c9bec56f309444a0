"""Loads the hand-written DuckDB oracles under ``oracles/``.

A query file starts with ``-- ctes: a b c``, naming CTE files under
``oracles/ctes`` in dependency order, followed by its final SELECT.
"""

from __future__ import annotations

import os
import re

ROOT = os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "oracles")


def _read(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def _strip_comments(sql: str) -> str:
    return "\n".join(line for line in sql.splitlines() if not line.lstrip().startswith("--")).strip()


def load(key: str) -> str | None:
    path = os.path.join(ROOT, "queries", f"{key}.sql")
    if not os.path.exists(path):
        return None
    text = _read(path)
    m = re.search(r"^--\s*ctes:(.*)$", text, re.M)
    names = m.group(1).split() if m else []
    body = _strip_comments(text)
    if not names:
        return body
    ctes = ",\n".join(_strip_comments(_read(os.path.join(ROOT, "ctes", f"{n}.sql"))) for n in names)
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
