-- Robust z of log1p(RPS) over the final view, hard-invalid rows, (month, dsp) audit.
rz AS (SELECT *, ln(1 + rps) AS lx FROM final_view),
rz_med AS (SELECT quantile_cont(lx, 0.5) AS med FROM rz),
rz_mad AS (SELECT quantile_cont(abs(lx - med), 0.5) AS mad FROM rz CROSS JOIN rz_med),
robust AS (
  SELECT rz.* EXCLUDE (lx),
    CASE WHEN mad > 0 THEN 0.6745 * (lx - med) / mad END AS robust_z_all,
    (coalesce(filled_revenue < 0, false) OR coalesce(total_streams <= 0, false)
      OR rps IS NULL OR isnan(rps) OR isinf(rps)) AS hard_invalid
  FROM rz CROSS JOIN rz_med CROSS JOIN rz_mad
),
suspicious AS (
  SELECT * EXCLUDE (hard_invalid) FROM robust
  WHERE NOT hard_invalid AND coalesce(abs(robust_z_all) > 5.5, false)
),
reliability AS (
  SELECT *,
    revenue_mid / (total_streams / 1000000.0) AS rps_mid,
    nowcast_rows / total_rows AS nowcast_rate,
    CASE WHEN revenue_mid > 0 THEN (revenue_upper - revenue_lower) / revenue_mid * 100 END AS uncertainty_width_pct,
    CASE WHEN nowcast_rows / total_rows >= 0.80
           OR coalesce((CASE WHEN revenue_mid > 0 THEN (revenue_upper - revenue_lower) / revenue_mid * 100 END) >= 35, false)
         THEN 'caution' ELSE 'normal' END AS risk_flag
  FROM (
    SELECT month, dsp,
      CAST(coalesce(sum(total_streams), 0) AS BIGINT) AS total_streams,
      coalesce(CAST(sum(CAST(CAST(filled_revenue AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE), 0.0) AS revenue_mid,
      coalesce(CAST(sum(CAST(CAST(nowcast_lower_90 AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE), 0.0) AS revenue_lower,
      coalesce(CAST(sum(CAST(CAST(nowcast_upper_90 AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE), 0.0) AS revenue_upper,
      count(*) FILTER (WHERE value_status = 'nowcasted') AS nowcast_rows,
      count(*) AS total_rows
    FROM final_view GROUP BY month, dsp) g
  WHERE total_streams > 0
),
rps_band AS (
  SELECT *,
    revenue_mid / nullif(total_streams / 1000000.0, 0) AS rps_mid,
    revenue_lower / nullif(total_streams / 1000000.0, 0) AS rps_lower_90,
    revenue_upper / nullif(total_streams / 1000000.0, 0) AS rps_upper_90,
    nowcast_rows / total_rows AS nowcast_rate,
    (revenue_upper - revenue_lower) / nullif(revenue_mid, 0) * 100 AS uncertainty_width_pct
  FROM (
    SELECT month, dsp,
      CAST(coalesce(sum(total_streams), 0) AS BIGINT) AS total_streams,
      coalesce(CAST(sum(CAST(CAST(filled_revenue AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE), 0.0) AS revenue_mid,
      coalesce(CAST(sum(CAST(CAST(CASE WHEN value_status = 'nowcasted' THEN nowcast_lower_90 ELSE filled_revenue END AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE), 0.0) AS revenue_lower,
      coalesce(CAST(sum(CAST(CAST(CASE WHEN value_status = 'nowcasted' THEN nowcast_upper_90 ELSE filled_revenue END AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE), 0.0) AS revenue_upper,
      count(*) FILTER (WHERE value_status = 'nowcasted') AS nowcast_rows,
      count(*) AS total_rows
    FROM final_view WHERE month IS NOT NULL AND dsp IS NOT NULL GROUP BY month, dsp) g
),
valid_final AS (
  SELECT * FROM final_view
  WHERE NOT (coalesce(filled_revenue < 0, false) OR coalesce(total_streams <= 0, false)
             OR rps IS NULL OR isnan(rps) OR isinf(rps))
),
rb AS (SELECT *, ln(1 + rps) AS lx FROM valid_final),
rb_med AS (SELECT value_status, dsp, quantile_cont(lx, 0.5) AS med FROM rb GROUP BY value_status, dsp),
rb_mad AS (
  SELECT rb.value_status, rb.dsp, quantile_cont(abs(rb.lx - m.med), 0.5) AS mad
  FROM rb JOIN rb_med m ON rb.value_status = m.value_status AND rb.dsp = m.dsp
  GROUP BY rb.value_status, rb.dsp
),
rule_b AS (
  SELECT rb.* EXCLUDE (lx),
    CASE WHEN d.mad > 0 THEN 0.6745 * (rb.lx - m.med) / d.mad END AS robust_z_dsp
  FROM rb
  LEFT JOIN rb_med m ON rb.value_status = m.value_status AND rb.dsp = m.dsp
  LEFT JOIN rb_mad d ON rb.value_status = d.value_status AND rb.dsp = d.dsp
),
rd_q AS (SELECT quantile_cont(rps, 0.005) AS lo, quantile_cont(rps, 0.995) AS hi FROM valid_final),
jumps AS (
  SELECT month, business_unit, territory_name, dsp,
    total_gross_amount / nullif(lag(total_gross_amount) OVER (
      PARTITION BY business_unit, territory_name, dsp ORDER BY month), 0) AS jr
  FROM final_view
)
