-- The four rule-based models of the stress test, one fit per repeat (grp).
bt_ga_cohort AS (
  SELECT grp, business_unit, territory_name, dsp, CAST(sum(CAST(CAST(total_gross_amount AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) / count(total_gross_amount) AS ga
  FROM nc_train GROUP BY grp, business_unit, territory_name, dsp
),
bt_ga_global AS (SELECT grp, CAST(sum(CAST(CAST(total_gross_amount AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) / count(total_gross_amount) AS gg FROM nc_train GROUP BY grp),
bt_naive_base AS (
  SELECT grp, month, business_unit, territory_name, dsp, total_gross_amount, false AS is_score FROM nc_train
  UNION ALL
  SELECT grp, month, business_unit, territory_name, dsp, total_gross_amount, true FROM nc_scored
),
bt_naive_lag AS (
  SELECT *, lag(total_gross_amount) OVER (PARTITION BY grp, business_unit, territory_name, dsp ORDER BY month) AS lag1
  FROM bt_naive_base
),
bt_naive_med AS (SELECT grp, quantile_cont(total_gross_amount, 0.5) AS med FROM nc_train GROUP BY grp),
bt_preds AS (
  SELECT 'Group Average' AS model, s.grp AS repeat, s.month, s.business_unit, s.territory_name, s.dsp,
    s.total_gross_amount, coalesce(c.ga, g.gg) AS pred
  FROM nc_scored s
  LEFT JOIN bt_ga_cohort c ON s.grp = c.grp AND s.business_unit = c.business_unit
       AND s.territory_name = c.territory_name AND s.dsp = c.dsp
  LEFT JOIN bt_ga_global g ON s.grp = g.grp
  UNION ALL
  SELECT 'EPSR', s.grp, s.month, s.business_unit, s.territory_name, s.dsp, s.total_gross_amount,
    s.total_streams * coalesce(c.r, td.r, d.r, g.r)
  FROM nc_scored s
  LEFT JOIN nc_rate_cohort c ON s.grp = c.grp AND s.business_unit = c.business_unit
       AND s.territory_name = c.territory_name AND s.dsp = c.dsp
  LEFT JOIN nc_rate_td td ON s.grp = td.grp AND s.territory_name = td.territory_name AND s.dsp = td.dsp
  LEFT JOIN nc_rate_dsp d ON s.grp = d.grp AND s.dsp = d.dsp
  LEFT JOIN nc_rate_global g ON s.grp = g.grp
  UNION ALL
  SELECT 'Naive', l.grp, l.month, l.business_unit, l.territory_name, l.dsp, l.total_gross_amount,
    CASE WHEN coalesce(l.lag1, m.med) IS NULL THEN NULL ELSE greatest(coalesce(l.lag1, m.med), 0.0) END
  FROM bt_naive_lag l LEFT JOIN bt_naive_med m ON l.grp = m.grp
  WHERE l.is_score
  UNION ALL
  SELECT 'Lag-Aware Hierarchical Nowcast', grp, month, business_unit, territory_name, dsp, total_gross_amount,
    nowcast_pred
  FROM nowcast WHERE role = 'score'
),
bt_overall AS (
  SELECT model, repeat, count(*) AS rows, CAST(sum(CAST(CAST(abs(total_gross_amount - pred) AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) / count(*) AS mae,
    CAST(sum(CAST(CAST(abs(total_gross_amount - pred) AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE)
    / nullif(CAST(sum(CAST(CAST(abs(total_gross_amount) AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE), 0) AS wmape
  FROM bt_preds GROUP BY model, repeat
),
bt_summary AS (
  SELECT model, avg(wmape) AS mean, stddev_samp(wmape) AS std,
    quantile_cont(wmape, 0.1) AS p10, quantile_cont(wmape, 0.5) AS p50, quantile_cont(wmape, 0.9) AS p90
  FROM bt_overall GROUP BY model
)
