-- ctes: panel
WITH j AS (
  SELECT month, business_unit, territory_name, dsp,
    lag(total_gross_amount) OVER (PARTITION BY business_unit, territory_name, dsp ORDER BY month) AS prev_value,
    total_gross_amount
  FROM panel
)
SELECT month, business_unit, territory_name, dsp, prev_value,
  total_gross_amount / nullif(prev_value, 0) AS jump_ratio,
  CASE WHEN total_gross_amount / nullif(prev_value, 0) < 0.1
         OR total_gross_amount / nullif(prev_value, 0) > 10.0 THEN 1 ELSE 0 END AS jump_flag
FROM j
