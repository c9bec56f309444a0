-- ctes: panel flagged lagged final_inputs nowcast_core intervals final audit
SELECT
  count(*) AS rows_total,
  count(*) FILTER (WHERE value_status = 'nowcasted') AS rows_nowcasted,
  count(*) FILTER (WHERE nowcast_reason = 'missing_or_zero_revenue') AS rows_nowcasted_missing_or_zero,
  count(*) FILTER (WHERE nowcast_reason = 'quality_flag_low_revenue_high_streams') AS rows_nowcasted_quality_flag,
  count(*) FILTER (WHERE value_status <> 'nowcasted') AS rows_actual,
  count(*) FILTER (WHERE nowcast_reason = 'quality_flag_low_revenue_high_streams') AS quality_flag_rows,
  count(*) FILTER (WHERE hard_invalid) AS hard_invalid_rows,
  (SELECT count(*) FROM suspicious) AS severe_suspicious_rows,
  (SELECT count(*) FROM reliability WHERE risk_flag = 'caution') AS dsp_month_caution_rows
FROM robust
