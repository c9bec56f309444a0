"""The pipeline gives the same answers however many slices the rank selection uses."""

from fillwise.plans.catalog import REGISTRY
from fillwise.plans.context import reset

SF = "/root/testdata/sf0.001"


def _rows(spark, key):
    return sorted(tuple(r) for r in REGISTRY[key](spark, SF).collect())


def test_slice_count_does_not_change_results(spark):
    keys = ["final_view", "suspicious_rows", "calibration_quantiles", "backtest_holdout"]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    reset()
    default = {k: _rows(spark, k) for k in keys}
    spark.conf.set("spark.sql.shuffle.partitions", "29")
    try:
        reset()
        more = {k: _rows(spark, k) for k in keys}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        reset()
    for k in keys:
        assert default[k] == more[k], k
