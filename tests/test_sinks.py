import json
import os

from fillwise.plans.context import context
from fillwise.plans.final_view import run_nowcast_and_audit
from fillwise.sources import io as sio

SF = "/root/testdata/sf0.001"


def test_run_outputs_written_and_read_back(spark, tmp_path):
    ctx = context(spark, SF)
    run = run_nowcast_and_audit(ctx.panel())
    out = str(tmp_path / "run")
    sio.write_outputs(run.final, run.suspicious, run.reliability, run.summary, out)
    final = spark.read.parquet(f"{out}/final_view")
    assert final.count() == run.final.count()
    files = [f for f in os.listdir(f"{out}/run_summary") if f.endswith(".json")]
    summary = json.loads(open(os.path.join(out, "run_summary", files[0])).read())
    assert summary["rows_total"] == summary["rows_nowcasted"] + summary["rows_actual"]
    assert summary["hard_invalid_rows"] >= 0
    sio.write_outputs(run.final, run.suspicious, run.reliability, run.summary, out + "_csv", fmt="csv")
    assert spark.read.option("header", True).csv(f"{out}_csv/final_view").count() == final.count()


def test_deliverable_invariants(spark):
    ctx = context(spark, SF)
    f = ctx.final()
    bad = f.where("nowcast_lower_90 > filled_revenue OR filled_revenue > nowcast_upper_90 OR nowcast_lower_90 < 0")
    assert bad.count() == 0
    assert f.where("value_status = 'actual' AND NOT (filled_revenue <=> total_gross_amount)").count() == 0
    assert f.count() == ctx.panel().count()


def test_run_from_csv_end_to_end(spark, tmp_path):
    from fillwise.plans.run import run_from_csv
    from fillwise.sources.fixtures import fixture_label_map, revenue_streams
    revenue, streams = revenue_streams(spark, SF)
    sio.write_csv(revenue, str(tmp_path / "rev"))
    sio.write_csv(streams, str(tmp_path / "str"))
    labels = {r.dsp: [] for r in fixture_label_map(spark).collect()}
    for r in fixture_label_map(spark).collect():
        labels[r.dsp].append(r.raw_dsp)
    run = run_from_csv(spark, str(tmp_path / "rev"), str(tmp_path / "str"), str(tmp_path / "out"), labels)
    assert spark.read.parquet(str(tmp_path / "out" / "final_view")).count() == run.final.count() > 0


def test_deliverable_invariant_under_input_order(spark, tmp_path):
    from pyspark.sql import functions as F
    ctx = context(spark, SF)
    panel = ctx.panel()
    shuffled_path = str(tmp_path / "shuffled")
    panel.orderBy(F.xxhash64("dsp", "territory_name", "month")).repartition(7).write.parquet(shuffled_path)
    a = run_nowcast_and_audit(panel)
    b = run_nowcast_and_audit(spark.read.parquet(shuffled_path))

    def rows(df):
        return sorted(tuple(None if v is None else (round(v, 6) if isinstance(v, float) else v) for v in r)
                      for r in df.collect())
    assert rows(a.final) == rows(b.final)
    assert rows(a.summary) == rows(b.summary)


def test_bad_amounts_and_swapped_columns_stop_the_run(spark, tmp_path):
    import pytest

    from fillwise.sources.io import read_revenue_csv
    head = "month,business_unit,territory_name,dsp,total_gross_amount\n"
    (tmp_path / "bad.csv").write_text(head + "2024-01-01,A,Brazil,Spotify,12x\n")
    (tmp_path / "swapped.csv").write_text("month,territory_name,business_unit,dsp,total_gross_amount\n2024-01-01,Brazil,A,Spotify,1\n")
    for name in ("bad.csv", "swapped.csv"):
        with pytest.raises(Exception):
            read_revenue_csv(spark, str(tmp_path / name)).collect()


def test_refresh_rewrites_only_the_months_that_differ(spark, tmp_path):
    import datetime as dt
    import glob

    from frames import m, panel
    rows = [(m(i), b, "T", d, 100 * i, 1.5 * i) for i in (1, 2, 3) for b in ("A", "B") for d in ("X", None)]
    path = str(tmp_path / "panel")

    def files():
        return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/month=*/*.parquet")}

    def saved():
        return sorted(map(str, sio.read_panel(spark, path).collect()))

    assert sio.refresh_panel(panel(spark, rows), path) == [m(1), m(2), m(3)]
    first = files()
    # the same rows in another order change nothing
    assert sio.refresh_panel(panel(spark, rows[::-1]).repartition(5), path) == []
    assert files() == first
    late = [r[:5] + (99.0,) if r[0] == m(2) and r[1] == "B" else r for r in rows] + [rows[0]]
    late = [r for r in late if r[0] != m(3)] + [(m(4), "A", "T", "X", 1, None), (None, "A", "T", "X", 1, 2.0)]
    # a repeated row, a changed amount, a month gone, a new one and a row without a month
    assert sio.refresh_panel(panel(spark, late), path) == [None, m(1), m(2), m(3), m(4)]
    assert saved() == sorted(map(str, panel(spark, late).collect()))
    assert sio.refresh_panel(panel(spark, late), path) == []
    before = files()
    one = [r[:5] + (7.0,) if r[0] == dt.date(2025, 4, 1) else r for r in late]
    assert sio.refresh_panel(panel(spark, one), path) == [m(4)]
    after = files()
    assert {f for f in before if "month=2025-04" not in f} == {f for f in after if "month=2025-04" not in f}
    assert all(after[f] == t for f, t in before.items() if f in after)
    assert saved() == sorted(map(str, panel(spark, one).collect()))


def test_profile_counts_rows_by_digest(spark):
    from fillwise.operators.profile import table_profile
    # neighbouring texts that join to the same string, nulls against their word, repeated rows
    rows = [("a", "bc"), ("ab", "c"), ("ab", "c"), (None, "null"), ("null", None), (None, None), (None, None), ("", "")]
    got = {r.column_name: r for r in table_profile(spark.createDataFrame(rows, "x string, `y.z` string"), "t").collect()}
    assert {c: (r["rows"], r.nulls, r.duplicate_rows) for c, r in got.items()} == {"x": (8, 3, 2), "y.z": (8, 3, 2)}
    empty = table_profile(spark.createDataFrame([], "x string"), "t").first()
    assert (empty["rows"], empty.nulls, empty.duplicate_rows) == (0, 0, 0)
