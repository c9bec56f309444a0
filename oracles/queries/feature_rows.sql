-- ctes: panel flagged lagged backtest
WITH th AS (SELECT *, month = (SELECT max(month) FROM bt_pool) AS is_val FROM bt_pool),
med AS (
  SELECT quantile_cont(CAST(gross_lag_1 AS DOUBLE), 0.5) AS mg,
         quantile_cont(CAST(streams_lag_1 AS DOUBLE), 0.5) AS ms,
         quantile_cont(CAST(epsr_lag_1 AS DOUBLE), 0.5) AS me
  FROM th WHERE NOT is_val
)
SELECT month, business_unit, territory_name, dsp, month_num, quarter, total_streams,
  ln(1 + CAST(total_streams AS DOUBLE)) AS log_streams,
  coalesce(CAST(gross_lag_1 AS DOUBLE), mg) AS gross_lag_1,
  coalesce(CAST(streams_lag_1 AS DOUBLE), ms) AS streams_lag_1,
  coalesce(CAST(epsr_lag_1 AS DOUBLE), me) AS epsr_lag_1
FROM th CROSS JOIN med WHERE is_val
