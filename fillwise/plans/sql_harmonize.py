"""S3: the harmonization as Spark SQL over registered temp views.

Both facts are brought to one shape (grain, streams, amount), stacked, and summed to the
grain in one GROUP BY. A row with a NULL key belongs to its own fact only, as no join
would match it, so such rows also group by the fact they come from. The label map is a
view of its own; a stream's country is kept where revenue knows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fillwise.config import OTHER_DSP, OTHER_TERRITORY
from fillwise.functions.money import MONEY_DECIMAL

HARMONIZE_SQL = f"""
SELECT month, business_unit, territory_name, dsp, total_streams, total_gross_amount,
       int(total_gross_amount IS NULL) AS is_na,
       int(total_gross_amount <=> 0D) AS is_zero
FROM (
  SELECT month, business_unit, territory_name, dsp,
         sum(plays) AS total_streams, double(sum(amount)) AS total_gross_amount
  FROM (
    SELECT 'streams' AS fact, month, business_unit,
           if(country IN (SELECT territory_name FROM {{revenue}}), country, '{OTHER_TERRITORY}') AS territory_name,
           dsp, bigint(total_streams) AS plays, CAST(NULL AS {MONEY_DECIMAL}) AS amount
    FROM {{streams}}
    UNION ALL
    SELECT 'revenue', month, business_unit, territory_name, ifnull(labels.dsp, '{OTHER_DSP}'),
           NULL, CAST(total_gross_amount AS {MONEY_DECIMAL})
    FROM {{revenue}} lines LEFT JOIN {{label_map}} labels ON labels.raw_dsp = lines.dsp)
  GROUP BY month, business_unit, territory_name, dsp,
           if(month IS NULL OR business_unit IS NULL OR territory_name IS NULL OR dsp IS NULL, fact, NULL))
"""


def register_views(revenue: DataFrame, streams: DataFrame, label_map: DataFrame, prefix: str = "fw") -> dict:
    names = {"revenue": f"{prefix}_revenue", "streams": f"{prefix}_streams", "label_map": f"{prefix}_label_map"}
    revenue.createOrReplaceTempView(names["revenue"])
    streams.createOrReplaceTempView(names["streams"])
    label_map.createOrReplaceTempView(names["label_map"])
    return names


def harmonize_sql(spark: SparkSession, revenue: DataFrame, streams: DataFrame, label_map: DataFrame,
                  prefix: str = "fw") -> DataFrame:
    return spark.sql(HARMONIZE_SQL.format(**register_views(revenue, streams, label_map, prefix)))
