-- Stress-test pools, the per-month holdout plan and the md5-ordered holdout rows.
bt_excluded AS (
  SELECT month_str FROM (SELECT DISTINCT month_str FROM lagged) ORDER BY month_str DESC LIMIT 2
),
bt_pool AS (
  SELECT * FROM lagged
  WHERE is_na = 0 AND is_zero = 0 AND total_streams > 0
    AND month_str NOT IN (SELECT month_str FROM bt_excluded)
),
bt_target AS (
  SELECT * FROM lagged
  WHERE (is_na = 1 OR is_zero = 1) AND month_str NOT IN (SELECT month_str FROM bt_excluded)
),
bt_counts AS (SELECT (SELECT count(*) FROM bt_pool) AS k, (SELECT count(*) FROM bt_target) AS t),
bt_share AS (
  SELECT month, count(*) AS target_rows, count(*) / (SELECT t FROM bt_counts) AS p0
  FROM bt_target WHERE month IN (SELECT month FROM bt_pool) GROUP BY month
),
bt_plan0 AS (
  SELECT s.month, s.target_rows, s.p0 / sum(s.p0) OVER () AS share,
    CAST(greatest(1, floor(c.k * (CAST(c.t AS DOUBLE) / (c.k + c.t)))) AS BIGINT) AS holdout_size
  FROM bt_share s CROSS JOIN bt_counts c
),
bt_plan1 AS (
  SELECT *, floor(share * holdout_size) AS base, share * holdout_size - floor(share * holdout_size) AS frac
  FROM bt_plan0
),
bt_plan AS (
  SELECT month, target_rows, share, holdout_size,
    CAST(base + CASE WHEN row_number() OVER (ORDER BY frac DESC, month) <= holdout_size - sum(base) OVER ()
                     THEN 1 ELSE 0 END AS BIGINT) AS holdout_rows
  FROM bt_plan1
),
bt_reps AS (SELECT CAST(range AS INTEGER) AS repeat FROM range(1, 31)),
bt_rows AS (
  SELECT r.repeat, p.*,
    md5(concat_ws('|', CAST(p.month AS VARCHAR), p.business_unit, p.territory_name, p.dsp,
                  CAST(r.repeat AS VARCHAR), '42')) AS skey
  FROM bt_pool p CROSS JOIN bt_reps r
),
bt_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY repeat, month ORDER BY skey) AS rn FROM bt_rows
),
bt_test AS (
  SELECT b.* EXCLUDE (rn) FROM bt_ranked b JOIN bt_plan pl ON b.month = pl.month
  WHERE b.rn <= pl.holdout_rows
),
bt_train AS (
  SELECT b.* FROM bt_rows b
  WHERE NOT EXISTS (SELECT 1 FROM bt_test t WHERE t.repeat = b.repeat AND t.month = b.month
                    AND t.business_unit = b.business_unit AND t.territory_name = b.territory_name
                    AND t.dsp = b.dsp)
)
