-- Relative 90% intervals: calibration = train rows scored by the same model.
pi_cal AS (
  SELECT grp, territory_name, dsp,
    abs(total_gross_amount - nowcast_pred) / greatest(abs(nowcast_pred), 1e-6) AS e
  FROM nowcast WHERE role = 'calib'
),
pi_global AS (SELECT grp, quantile_cont(e, 0.9) AS gq FROM pi_cal GROUP BY grp),
pi_group AS (
  SELECT grp, territory_name, dsp, count(*) AS n, quantile_cont(e, 0.9) AS q
  FROM pi_cal GROUP BY grp, territory_name, dsp
),
scored AS (
  SELECT n.*,
    coalesce(CASE WHEN q.n >= 30 THEN q.q END, g.gq, 0.25) AS pi_q,
    greatest(n.nowcast_pred * (1 - coalesce(CASE WHEN q.n >= 30 THEN q.q END, g.gq, 0.25)), 0.0) AS nowcast_lower_90,
    greatest(n.nowcast_pred * (1 + coalesce(CASE WHEN q.n >= 30 THEN q.q END, g.gq, 0.25)), 0.0) AS nowcast_upper_90
  FROM nowcast n
  LEFT JOIN pi_group q ON n.grp = q.grp AND n.territory_name = q.territory_name AND n.dsp = q.dsp
  LEFT JOIN pi_global g ON n.grp = g.grp
  WHERE n.role = 'score'
)
