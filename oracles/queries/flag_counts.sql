-- ctes: panel flagged
WITH f AS (SELECT *, strftime(month, '%Y-%m') AS month_str FROM flagged)
SELECT business_unit, territory_name, dsp, month_str,
  CAST(sum(is_na) AS BIGINT) AS is_na, CAST(sum(is_zero) AS BIGINT) AS is_zero,
  CAST(sum(quality_flag_low_revenue_high_streams) AS BIGINT) AS quality_flag_low_revenue_high_streams,
  CAST(grouping_id(business_unit, territory_name, dsp, month_str) AS INTEGER) AS level
FROM f
GROUP BY GROUPING SETS ((business_unit, territory_name, dsp), (business_unit), (territory_name), (dsp), (month_str))
