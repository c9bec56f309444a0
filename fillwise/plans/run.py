"""End-to-end runs from files, as the reference's command line does them.

``run_from_csv``: harmonize revenue and streams CSVs (declared schemas), keep the
panel as month-partitioned parquet, then nowcast, audit and write the outputs.
``run_from_panel``: reuse a saved panel (the reference's fast rerun).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fillwise.config import DEFAULT, REFERENCE_DSP_FAMILIES, Params
from fillwise.operators.harmonize import harmonize, label_map_frame
from fillwise.plans.final_view import RunOutputs, run_nowcast_and_audit
from fillwise.sources import io as sio


def run_panel(spark: SparkSession, panel: DataFrame, out_dir: str, params: Params = DEFAULT,
              fmt: str = "parquet") -> RunOutputs:
    run = run_nowcast_and_audit(panel, params)
    sio.write_outputs(run.final, run.suspicious, run.reliability, run.summary, out_dir, fmt)
    return run


def run_from_csv(spark: SparkSession, revenue_csv: str, streams_csv: str, out_dir: str,
                 families: dict | None = None, params: Params = DEFAULT, fmt: str = "parquet") -> RunOutputs:
    revenue = sio.read_revenue_csv(spark, revenue_csv)
    streams = sio.read_streams_csv(spark, streams_csv)
    panel = harmonize(revenue, streams, label_map_frame(spark, families or REFERENCE_DSP_FAMILIES))
    sio.write_panel(panel, f"{out_dir}/panel")
    return run_panel(spark, sio.read_panel(spark, f"{out_dir}/panel"), out_dir, params, fmt)


def run_from_panel(spark: SparkSession, panel_path: str, out_dir: str, params: Params = DEFAULT,
                   fmt: str = "parquet") -> RunOutputs:
    return run_panel(spark, sio.read_panel(spark, panel_path), out_dir, params, fmt)
