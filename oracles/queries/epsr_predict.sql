-- ctes: panel flagged lagged backtest
WITH ka AS (SELECT * FROM lagged WHERE is_na = 0 AND is_zero = 0 AND total_streams > 0),
c AS (
  SELECT business_unit, territory_name, dsp,
    CAST(sum(CAST(CAST(total_gross_amount AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) / nullif(sum(total_streams), 0) AS r
  FROM ka GROUP BY business_unit, territory_name, dsp
),
td AS (
  SELECT territory_name, dsp,
    CAST(sum(CAST(CAST(total_gross_amount AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) / nullif(sum(total_streams), 0) AS r
  FROM ka GROUP BY territory_name, dsp
),
d AS (
  SELECT dsp, CAST(sum(CAST(CAST(total_gross_amount AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) / nullif(sum(total_streams), 0) AS r
  FROM ka GROUP BY dsp
),
g AS (SELECT CAST(sum(CAST(CAST(total_gross_amount AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) / nullif(sum(total_streams), 0) AS r FROM ka)
SELECT p.month, p.business_unit, p.territory_name, p.dsp,
  p.total_streams * coalesce(c.r, td.r, d.r, g.r) AS pred
FROM bt_pool p
LEFT JOIN c ON p.business_unit = c.business_unit AND p.territory_name = c.territory_name AND p.dsp = c.dsp
LEFT JOIN td ON p.territory_name = td.territory_name AND p.dsp = td.dsp
LEFT JOIN d ON p.dsp = d.dsp
CROSS JOIN g
