"""Print the scale-relevant facts of a registered query's executed plan: scans
with their pushed filters and read schema, join strategies, exchanges and reuse.

usage: python tools/show_plans.py [sf_dir] key [key ...]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fillwise.plans.catalog import REGISTRY  # noqa: E402
from fillwise.session import build_session  # noqa: E402

JOINS = r"(BroadcastHashJoin|SortMergeJoin|BroadcastNestedLoopJoin|CartesianProduct|ShuffledHashJoin)"


def describe(df) -> str:
    df.collect()                      # executed: AQE prints the final plan
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    final = text.split("== Initial Plan ==")[0]
    out = [f"joins: {dict(Counter(re.findall(JOINS, final.split('(1)')[0])))}",
           f"exchanges: {final.split('(1)')[0].count('Exchange')}  reused: {final.count('ReusedExchange')}"]
    for block in re.findall(r"\(\d+\) Scan parquet.*?(?=\n\(\d+\)|\Z)", final, re.S):
        loc = re.search(r"Location: \S+ \[(.*?)\]", block)
        pushed = re.search(r"PushedFilters: (\[.*?\])", block)
        schema = re.search(r"ReadSchema: (struct<.*?>)", block)
        out.append(f"scan {loc.group(1).split('/')[-1] if loc else '?'}: pushed={pushed.group(1) if pushed else '[]'} "
                   f"schema={schema.group(1)[:120] if schema else '?'}")
    return "\n".join(out)


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    spark = build_session()
    for key in args:
        print(f"== {key}")
        print(describe(REGISTRY[key](spark, sf_dir)))


if __name__ == "__main__":
    main()
