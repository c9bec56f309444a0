-- The 12-column deliverable: nowcast rows and actual rows.
final_view AS (
  SELECT month, business_unit, territory_name, dsp, total_streams, total_gross_amount,
    nowcast_pred AS filled_revenue, nowcast_lower_90, nowcast_upper_90,
    'nowcasted' AS value_status,
    CASE WHEN is_na = 1 OR is_zero = 1 THEN 'missing_or_zero_revenue'
         WHEN quality_flag_low_revenue_high_streams = 1 THEN 'quality_flag_low_revenue_high_streams'
         ELSE 'N/A' END AS nowcast_reason,
    CASE WHEN total_streams > 0 THEN nowcast_pred / (total_streams / 1000000.0) END AS rps
  FROM scored
  UNION ALL
  SELECT month, business_unit, territory_name, dsp, total_streams, total_gross_amount,
    total_gross_amount AS filled_revenue, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE),
    'actual', 'N/A',
    CASE WHEN total_streams > 0 THEN total_gross_amount / (total_streams / 1000000.0) END
  FROM lagged
  WHERE NOT (is_na = 1 OR is_zero = 1 OR quality_flag_low_revenue_high_streams = 1)
)
