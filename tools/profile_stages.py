"""Stage timings of registered queries from Spark's event log (no UI).

usage: python tools/profile_stages.py [sf_dir] key [key ...]
Writes the event log to a fresh scratch folder and prints, per query: wall time,
jobs, stages, summed stage time and the slowest stages.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fillwise.plans.catalog import REGISTRY  # noqa: E402
from fillwise.plans.context import reset  # noqa: E402
from fillwise.session import build_session  # noqa: E402


def _events(log_dir: str):
    for path in sorted(glob.glob(os.path.join(log_dir, "**", "events_*"), recursive=True)
                       + glob.glob(os.path.join(log_dir, "local-*"))):
        raw = open(path, "rb")
        if path.endswith(".zstd"):
            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(raw)
        for line in io.TextIOWrapper(raw, encoding="utf-8"):
            try:
                yield json.loads(line)
            except ValueError:
                continue


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    log_dir = tempfile.mkdtemp(prefix="fillwise-events-")
    spark = build_session(extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log_dir}"})
    walls = {}
    for key in args:
        reset()
        spark.sparkContext.setJobDescription(key)
        t0 = time.time()
        REGISTRY[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        walls[key] = time.time() - t0
    spark.sparkContext.setJobDescription(None)
    spark.stop()

    jobs, stages = {}, {}
    for e in _events(log_dir):
        ev = e.get("Event")
        if ev == "SparkListenerJobStart":
            jobs[e["Job ID"]] = (e.get("Properties", {}).get("spark.job.description"),
                                 [s["Stage ID"] for s in e["Stage Infos"]])
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (si["Stage Name"].split(" at ")[0][:60],
                                      si.get("Completion Time", 0) - si.get("Submission Time", 0),
                                      si["Number of Tasks"])
    for key in args:
        run = [sid for desc, sids in jobs.values() if desc == key for sid in sids if sid in stages]
        n_jobs = sum(1 for desc, _ in jobs.values() if desc == key)
        print(f"== {key}: wall {walls[key]:.1f}s, {n_jobs} jobs, {len(run)} stages, "
              f"stage time {sum(stages[s][1] for s in run) / 1000:.1f}s (stages overlap)")
        for sid in sorted(run, key=lambda s: -stages[s][1])[:5]:
            name, ms, tasks = stages[sid]
            print(f"   stage {sid}: {ms} ms, {tasks} tasks, {name}")
    print("event log:", log_dir)


if __name__ == "__main__":
    main()
