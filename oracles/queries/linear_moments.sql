-- ctes: panel flagged lagged backtest
WITH p AS (SELECT *, CAST(total_gross_amount AS DOUBLE) AS y FROM bt_pool),
long AS (
  SELECT 'one' AS feature, y AS v FROM p
  UNION ALL SELECT 'business_unit=' || business_unit, y FROM p
  UNION ALL SELECT 'territory_name=' || territory_name, y FROM p
  UNION ALL SELECT 'dsp=' || dsp, y FROM p
  UNION ALL SELECT 'month_num', month(month) * y FROM p
  UNION ALL SELECT 'quarter', quarter(month) * y FROM p
  UNION ALL SELECT 'total_streams', total_streams * y FROM p
  UNION ALL SELECT 'log_streams', ln(1 + CAST(total_streams AS DOUBLE)) * y FROM p
  UNION ALL SELECT 'gross_lag_1', coalesce(gross_lag_1, 0) * y FROM p
  UNION ALL SELECT 'streams_lag_1', coalesce(streams_lag_1, 0) * y FROM p
  UNION ALL SELECT 'epsr_lag_1', coalesce(epsr_lag_1, 0) * y FROM p
  UNION ALL SELECT 'gross_lag_1 missing', CASE WHEN gross_lag_1 IS NULL THEN y ELSE 0 END FROM p
  UNION ALL SELECT 'streams_lag_1 missing', CASE WHEN streams_lag_1 IS NULL THEN y ELSE 0 END FROM p
  UNION ALL SELECT 'epsr_lag_1 missing', CASE WHEN epsr_lag_1 IS NULL THEN y ELSE 0 END FROM p
)
SELECT feature, sum(v) / (SELECT count(*) FROM p) AS mean_product FROM long GROUP BY feature
