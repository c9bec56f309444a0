-- ctes: panel flagged lagged backtest
WITH ka AS (SELECT * FROM lagged WHERE is_na = 0 AND is_zero = 0 AND total_streams > 0),
gc AS (
  SELECT business_unit, territory_name, dsp,
    CAST(sum(CAST(CAST(total_gross_amount AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) / count(total_gross_amount) AS ga
  FROM ka GROUP BY business_unit, territory_name, dsp
),
gg AS (SELECT CAST(sum(CAST(CAST(total_gross_amount AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) / count(total_gross_amount) AS gg FROM ka),
rc AS (
  SELECT business_unit, territory_name, dsp,
    CAST(sum(CAST(CAST(total_gross_amount AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) / nullif(sum(total_streams), 0) AS r
  FROM ka GROUP BY business_unit, territory_name, dsp
),
rtd AS (
  SELECT territory_name, dsp,
    CAST(sum(CAST(CAST(total_gross_amount AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) / nullif(sum(total_streams), 0) AS r
  FROM ka GROUP BY territory_name, dsp
),
rd AS (
  SELECT dsp, CAST(sum(CAST(CAST(total_gross_amount AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) / nullif(sum(total_streams), 0) AS r
  FROM ka GROUP BY dsp
),
rg AS (SELECT CAST(sum(CAST(CAST(total_gross_amount AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) / nullif(sum(total_streams), 0) AS r FROM ka),
preds AS (
  SELECT 'Group Average Baseline' AS model, p.total_gross_amount, coalesce(gc.ga, gg.gg) AS pred
  FROM bt_pool p
  LEFT JOIN gc ON p.business_unit = gc.business_unit AND p.territory_name = gc.territory_name AND p.dsp = gc.dsp
  CROSS JOIN gg
  UNION ALL
  SELECT 'Naive Baseline', total_gross_amount, gross_lag_1 FROM bt_pool WHERE gross_lag_1 IS NOT NULL
  UNION ALL
  SELECT 'EPSR', p.total_gross_amount, p.total_streams * coalesce(rc.r, rtd.r, rd.r, rg.r)
  FROM bt_pool p
  LEFT JOIN rc ON p.business_unit = rc.business_unit AND p.territory_name = rc.territory_name AND p.dsp = rc.dsp
  LEFT JOIN rtd ON p.territory_name = rtd.territory_name AND p.dsp = rtd.dsp
  LEFT JOIN rd ON p.dsp = rd.dsp
  CROSS JOIN rg
)
SELECT model, count(*) AS rows,
  CAST(sum(CAST(CAST(abs(total_gross_amount - pred) AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) / count(*) AS mae,
  CAST(sum(CAST(CAST(abs(total_gross_amount - pred) AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE)
    / nullif(CAST(sum(CAST(CAST(abs(total_gross_amount) AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE), 0) AS wmape
FROM preds GROUP BY model
