-- ctes: panel flagged lagged final_inputs nowcast_core intervals final
WITH pc AS (
  SELECT count(*) AS rows,
    count(*) FILTER (WHERE month IS NULL) AS month,
    count(*) FILTER (WHERE business_unit IS NULL) AS business_unit,
    count(*) FILTER (WHERE territory_name IS NULL) AS territory_name,
    count(*) FILTER (WHERE dsp IS NULL) AS dsp,
    count(*) FILTER (WHERE total_streams IS NULL) AS total_streams,
    count(*) FILTER (WHERE total_gross_amount IS NULL) AS total_gross_amount,
    count(*) FILTER (WHERE is_na IS NULL) AS is_na,
    count(*) FILTER (WHERE is_zero IS NULL) AS is_zero
  FROM panel
),
fc AS (
  SELECT count(*) AS rows,
    count(*) FILTER (WHERE month IS NULL) AS month,
    count(*) FILTER (WHERE business_unit IS NULL) AS business_unit,
    count(*) FILTER (WHERE territory_name IS NULL) AS territory_name,
    count(*) FILTER (WHERE dsp IS NULL) AS dsp,
    count(*) FILTER (WHERE total_streams IS NULL) AS total_streams,
    count(*) FILTER (WHERE total_gross_amount IS NULL) AS total_gross_amount,
    count(*) FILTER (WHERE filled_revenue IS NULL) AS filled_revenue,
    count(*) FILTER (WHERE nowcast_lower_90 IS NULL) AS nowcast_lower_90,
    count(*) FILTER (WHERE nowcast_upper_90 IS NULL) AS nowcast_upper_90,
    count(*) FILTER (WHERE value_status IS NULL) AS value_status,
    count(*) FILTER (WHERE nowcast_reason IS NULL) AS nowcast_reason,
    count(*) FILTER (WHERE rps IS NULL) AS rps
  FROM final_view
)
SELECT 'panel' AS table_name, column_name, rows, nulls,
  rows - (SELECT count(*) FROM (SELECT DISTINCT * FROM panel)) AS duplicate_rows
FROM (UNPIVOT pc ON month, business_unit, territory_name, dsp, total_streams, total_gross_amount, is_na, is_zero
      INTO NAME column_name VALUE nulls)
UNION ALL
SELECT 'final_view', column_name, rows, nulls,
  rows - (SELECT count(*) FROM (SELECT DISTINCT * FROM final_view))
FROM (UNPIVOT fc ON month, business_unit, territory_name, dsp, total_streams, total_gross_amount, filled_revenue,
      nowcast_lower_90, nowcast_upper_90, value_status, nowcast_reason, rps
      INTO NAME column_name VALUE nulls)
