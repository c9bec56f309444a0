-- ctes: panel flagged lagged final_inputs nowcast_core intervals
SELECT territory_name, dsp,
  CAST(sum(CAST(CAST(nowcast_pred AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) AS reconciled_sum,
  CAST(sum(CAST(CAST(anchor_pred AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) AS anchor_sum,
  count(*) AS rows,
  CAST(grouping_id(territory_name, dsp) AS INTEGER) AS level,
  CAST(sum(CAST(CAST(nowcast_pred AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE)
    / nullif(CAST(sum(CAST(CAST(anchor_pred AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE), 0) AS ratio
FROM scored GROUP BY ROLLUP (territory_name, dsp)
