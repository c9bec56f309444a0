-- ctes: panel flagged lagged backtest
WITH ka AS (SELECT * FROM lagged WHERE is_na = 0 AND is_zero = 0 AND total_streams > 0),
c AS (
  SELECT business_unit, territory_name, dsp,
    CAST(sum(CAST(CAST(total_gross_amount AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) / count(total_gross_amount) AS ga
  FROM ka GROUP BY business_unit, territory_name, dsp
),
g AS (SELECT CAST(sum(CAST(CAST(total_gross_amount AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) / count(total_gross_amount) AS gg FROM ka)
SELECT p.month, p.business_unit, p.territory_name, p.dsp, coalesce(c.ga, g.gg) AS pred
FROM bt_pool p
LEFT JOIN c ON p.business_unit = c.business_unit AND p.territory_name = c.territory_name AND p.dsp = c.dsp
CROSS JOIN g
