-- Lag-aware hierarchical nowcast over nc_train / nc_scored, one model per grp.
-- Revenue sums are exact DECIMAL sums, as in the engine.
nc_rate_cohort AS (
  SELECT grp, business_unit, territory_name, dsp,
         CAST(sum(CAST(CAST(total_gross_amount AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) / nullif(sum(total_streams), 0) AS r
  FROM nc_train GROUP BY grp, business_unit, territory_name, dsp
),
nc_rate_td AS (
  SELECT grp, territory_name, dsp, CAST(sum(CAST(CAST(total_gross_amount AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) / nullif(sum(total_streams), 0) AS r
  FROM nc_train GROUP BY grp, territory_name, dsp
),
nc_rate_dsp AS (
  SELECT grp, dsp, CAST(sum(CAST(CAST(total_gross_amount AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) / nullif(sum(total_streams), 0) AS r
  FROM nc_train GROUP BY grp, dsp
),
nc_rate_global AS (
  SELECT grp, CAST(sum(CAST(CAST(total_gross_amount AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) / nullif(sum(total_streams), 0) AS r,
         coalesce(CAST(sum(CAST(CAST(total_gross_amount AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE)
                  / greatest(CAST(sum(total_streams) AS DOUBLE), 1.0), 0.0) AS gepsr
  FROM nc_train GROUP BY grp
),
nc_anchor AS (
  SELECT s.*,
    greatest(coalesce(CAST(s.total_streams AS DOUBLE), 0.0), 0.0) AS ss,
    greatest(coalesce(s.total_streams * coalesce(c.r, td.r, d.r, g.r),
                      greatest(greatest(coalesce(CAST(s.total_streams AS DOUBLE), 0.0), 0.0)
                               * coalesce(g.gepsr, 0.0), 0.0)), 0.0) AS anchor_pred
  FROM nc_scored s
  LEFT JOIN nc_rate_cohort c ON s.grp = c.grp AND s.business_unit = c.business_unit
       AND s.territory_name = c.territory_name AND s.dsp = c.dsp
  LEFT JOIN nc_rate_td td ON s.grp = td.grp AND s.territory_name = td.territory_name AND s.dsp = td.dsp
  LEFT JOIN nc_rate_dsp d ON s.grp = d.grp AND s.dsp = d.dsp
  LEFT JOIN nc_rate_global g ON s.grp = g.grp
),
nc_growth AS (
  SELECT *,
    CASE WHEN ss / nullif(CAST(streams_lag_1 AS DOUBLE), 0) IS NULL THEN NULL
         ELSE least(greatest(ss / nullif(CAST(streams_lag_1 AS DOUBLE), 0), 0.5), 1.8) END AS growth
  FROM nc_anchor
),
nc_proj AS (
  SELECT *,
    CASE WHEN gross_lag_1 * growth IS NULL THEN NULL ELSE greatest(gross_lag_1 * growth, 0.0) END AS lag_proj
  FROM nc_growth
),
nc_blend AS (
  SELECT *,
    anchor_pred * least(greatest(coalesce(
      (CASE WHEN lag_proj IS NOT NULL THEN 0.2 * lag_proj + 0.8 * anchor_pred ELSE anchor_pred END)
      / nullif(anchor_pred, 0), 1.0), 0.85), 1.15) AS blended_pred
  FROM nc_proj
),
nc_sums AS (
  SELECT grp, role, month, dsp, sum(blended_pred) AS raw_sum, sum(anchor_pred) AS anchor_sum
  FROM nc_blend GROUP BY grp, role, month, dsp
),
nc_recon AS (
  SELECT b.*,
    coalesce(greatest(b.blended_pred * coalesce(
      CASE WHEN r.raw_sum > 0 THEN least(greatest(r.anchor_sum / r.raw_sum, 0.85), 1.15) ELSE 1.0 END, 1.0), 0.0),
      0.0) AS reconciled
  FROM nc_blend b
  LEFT JOIN nc_sums r ON b.grp = r.grp AND b.role = r.role AND b.month = r.month AND b.dsp = r.dsp
),
gr_train AS (
  SELECT grp, dsp, total_gross_amount / (total_streams / 1000000.0) AS rps
  FROM nc_train
  WHERE total_streams IS NOT NULL AND total_streams > 0
    AND total_gross_amount IS NOT NULL AND total_gross_amount >= 0
),
gr_dsp AS (
  SELECT grp, dsp, quantile_cont(rps, 0.5) AS med, quantile_cont(rps, 0.95) AS p95
  FROM gr_train GROUP BY grp, dsp
),
gr_global AS (
  SELECT grp, quantile_cont(rps, 0.5) AS gmed, quantile_cont(rps, 0.95) AS gp95
  FROM gr_train GROUP BY grp
),
gr_cap AS (
  SELECT r.*,
    greatest(3.0 * coalesce(d.med, g.gmed), 1.25 * coalesce(d.p95, g.gp95)) AS cap
  FROM nc_recon r
  LEFT JOIN gr_dsp d ON r.grp = d.grp AND r.dsp = d.dsp
  LEFT JOIN gr_global g ON r.grp = g.grp
),
nowcast AS (
  SELECT * EXCLUDE (cap, ss, growth),
    CASE WHEN cap IS NULL THEN reconciled
         WHEN ss > 0 THEN greatest(least(greatest(coalesce(reconciled, 0.0), 0.0), cap * (ss / 1000000.0)), 0.0)
         ELSE 0.0 END AS nowcast_pred,
    CASE WHEN cap IS NULL THEN false
         ELSE coalesce(CASE WHEN ss > 0 THEN greatest(coalesce(reconciled, 0.0), 0.0) / (ss / 1000000.0) END > cap,
                       false) END AS guardrail_applied
  FROM gr_cap
)
