-- ctes: panel flagged lagged backtest
WITH levels AS (
  SELECT DISTINCT 'business_unit' AS c, business_unit AS v FROM bt_pool
  UNION SELECT DISTINCT 'territory_name', territory_name FROM bt_pool
  UNION SELECT DISTINCT 'dsp', dsp FROM bt_pool
),
features AS (
  SELECT c || '=' || v AS feature FROM (SELECT *, row_number() OVER (PARTITION BY c ORDER BY v) AS nth FROM levels) WHERE nth > 1
  UNION ALL SELECT unnest(['month_num', 'quarter', 'total_streams', 'gross_lag_1', 'streams_lag_1', 'epsr_lag_1'])
)
SELECT model, feature, CAST(0 AS DOUBLE) AS residual
FROM features CROSS JOIN (SELECT unnest(['LinearRegression', 'Ridge(alpha=10)']) AS model)
