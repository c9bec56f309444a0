-- ctes: panel flagged lagged final_inputs nowcast_core intervals final audit
SELECT dsp,
  strftime(min(month), '%Y-%m') AS first_month,
  strftime(max(month), '%Y-%m') AS last_month,
  (arg_max(rps_mid, month) / nullif(arg_min(rps_mid, month), 0) - 1) * 100 AS rps_growth_pct,
  (arg_max(rps_upper_90, month) - arg_max(rps_lower_90, month)) / nullif(arg_max(rps_mid, month), 0) * 100
    AS latest_uncertainty_width_pct
FROM rps_band GROUP BY dsp
