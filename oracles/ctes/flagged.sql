-- Fixed-effects low-revenue flag on the panel (q = 0.03, groups of >= 24 rows).
fe_known AS (
  SELECT territory_name, dsp, ln(greatest(total_gross_amount / total_streams, 1e-12)) AS z
  FROM panel
  WHERE is_na = 0 AND is_zero = 0 AND total_streams > 0 AND total_gross_amount > 0
),
fe_global AS (SELECT avg(z) AS mu FROM fe_known),
fe_territory AS (
  SELECT territory_name, avg(z) AS t_mean, count(*) AS t_n FROM fe_known GROUP BY territory_name
),
fe_dsp AS (SELECT dsp, avg(z) AS d_mean, count(*) AS d_n FROM fe_known GROUP BY dsp),
fe_resid AS (
  SELECT p.*,
    CASE WHEN p.is_na = 0 AND p.is_zero = 0 AND p.total_streams > 0 AND p.total_gross_amount > 0
         THEN 1 ELSE 0 END AS known_row,
    CASE WHEN p.is_na = 0 AND p.is_zero = 0 AND p.total_streams > 0 AND p.total_gross_amount > 0
         THEN ln(greatest(p.total_gross_amount / p.total_streams, 1e-12))
              - (g.mu
                 + CASE WHEN coalesce(t.t_n, 0) >= 24 THEN t.t_mean - g.mu ELSE 0 END
                 + CASE WHEN coalesce(d.d_n, 0) >= 24 THEN d.d_mean - g.mu ELSE 0 END)
    END AS resid
  FROM panel p
  CROSS JOIN fe_global g
  LEFT JOIN fe_territory t ON p.territory_name = t.territory_name
  LEFT JOIN fe_dsp d ON p.dsp = d.dsp
),
fe_tau AS (
  SELECT coalesce(quantile_cont(resid, 0.03), -1.0) AS tau FROM fe_resid WHERE known_row = 1
),
flagged AS (
  SELECT month, business_unit, territory_name, dsp, total_streams, total_gross_amount, is_na, is_zero,
    CASE WHEN known_row = 1 AND resid <= (SELECT tau FROM fe_tau) THEN 1 ELSE 0 END
      AS quality_flag_low_revenue_high_streams
  FROM fe_resid
)
