-- ctes: panel flagged lagged final_inputs nowcast_core intervals final
WITH s AS (
  SELECT business_unit AS business_unit,
    count(*) AS total_rows,
    count(*) FILTER (WHERE value_status = 'nowcasted') AS nowcast_rows,
    count(*) FILTER (WHERE value_status = 'nowcasted' AND nowcast_reason = 'missing_or_zero_revenue')
      AS reason_missing_or_zero,
    count(*) FILTER (WHERE value_status = 'nowcasted' AND nowcast_reason = 'quality_flag_low_revenue_high_streams')
      AS reason_quality_flag,
    CAST(coalesce(sum(total_streams), 0) AS BIGINT) AS total_streams,
    CAST(sum(CAST(CAST(coalesce(total_gross_amount, 0.0) AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) AS reported_revenue,
    coalesce(CAST(sum(CAST(CAST(filled_revenue AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE), 0.0) AS filled_revenue
  FROM final_view GROUP BY 1
)
SELECT business_unit, total_rows, total_rows - nowcast_rows AS actual_rows, nowcast_rows,
  nowcast_rows / total_rows * 100 AS nowcast_rate_pct,
  reason_missing_or_zero, reason_quality_flag, total_streams, reported_revenue, filled_revenue,
  filled_revenue - reported_revenue AS revenue_uplift
FROM s
