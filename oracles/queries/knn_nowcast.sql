-- ctes: panel flagged lagged backtest
WITH med AS (
  SELECT quantile_cont(CAST(gross_lag_1 AS DOUBLE), 0.5) AS mg,
         quantile_cont(CAST(streams_lag_1 AS DOUBLE), 0.5) AS ms,
         quantile_cont(CAST(epsr_lag_1 AS DOUBLE), 0.5) AS me
  FROM bt_pool
),
rows_ AS (
  SELECT * FROM (SELECT true AS train, * FROM bt_pool
                 UNION ALL
                 SELECT false, * FROM lagged
                 WHERE is_na = 1 OR is_zero = 1 OR quality_flag_low_revenue_high_streams = 1)
),
f AS (
  SELECT train, month, business_unit, territory_name, dsp, total_gross_amount AS y,
    CAST('0x' || substr(md5(concat_ws('|', CAST(month AS VARCHAR), business_unit, territory_name, dsp)), 1, 15) AS BIGINT) AS tid,
    [CAST(month(month) AS DOUBLE), CAST(quarter(month) AS DOUBLE), CAST(total_streams AS DOUBLE), ln(1 + CAST(total_streams AS DOUBLE)),
     coalesce(CAST(gross_lag_1 AS DOUBLE), mg), coalesce(CAST(streams_lag_1 AS DOUBLE), ms), coalesce(CAST(epsr_lag_1 AS DOUBLE), me)] AS v
  FROM rows_ CROSS JOIN med
),
scale AS (
  SELECT list(CASE WHEN s > 0 THEN s ELSE 1 END ORDER BY i) AS s
  FROM (SELECT i, stddev_pop(v[i]) AS s FROM f, range(1, 8) r(i) WHERE train GROUP BY i)
),
-- squared length of one standardized dummy: 1 / variance, and 1 for a constant one
u AS (SELECT business_unit, CASE WHEN avg(m) < 1 THEN 1 / (avg(m) * (1 - avg(m))) ELSE 1 END AS w
      FROM (SELECT business_unit, count(*) / (SELECT count(*) FROM f WHERE train) AS m FROM f WHERE train GROUP BY 1) GROUP BY 1),
t AS (SELECT territory_name, CASE WHEN avg(m) < 1 THEN 1 / (avg(m) * (1 - avg(m))) ELSE 1 END AS w
      FROM (SELECT territory_name, count(*) / (SELECT count(*) FROM f WHERE train) AS m FROM f WHERE train GROUP BY 1) GROUP BY 1),
d AS (SELECT dsp, CASE WHEN avg(m) < 1 THEN 1 / (avg(m) * (1 - avg(m))) ELSE 1 END AS w
      FROM (SELECT dsp, count(*) / (SELECT count(*) FROM f WHERE train) AS m FROM f WHERE train GROUP BY 1) GROUP BY 1),
g AS (
  SELECT f.*, list_transform(list_zip(v, s), lambda p: p[1] / p[2]) AS z,
    coalesce(u.w, 0) AS wu, coalesce(t.w, 0) AS wt, coalesce(d.w, 0) AS wd
  FROM f CROSS JOIN scale LEFT JOIN u USING (business_unit) LEFT JOIN t USING (territory_name) LEFT JOIN d USING (dsp)
),
pairs AS (
  SELECT q.month, q.business_unit, q.territory_name, q.dsp, p.y, p.tid,
    sqrt((q.z[1] - p.z[1])**2 + (q.z[2] - p.z[2])**2 + (q.z[3] - p.z[3])**2 + (q.z[4] - p.z[4])**2
       + (q.z[5] - p.z[5])**2 + (q.z[6] - p.z[6])**2 + (q.z[7] - p.z[7])**2
       + CASE WHEN q.business_unit = p.business_unit THEN 0 ELSE q.wu + p.wu END
       + CASE WHEN q.territory_name = p.territory_name THEN 0 ELSE q.wt + p.wt END
       + CASE WHEN q.dsp = p.dsp THEN 0 ELSE q.wd + p.wd END) AS dist
  FROM g q CROSS JOIN g p WHERE p.train AND NOT q.train
),
near AS (
  SELECT * FROM pairs
  QUALIFY row_number() OVER (PARTITION BY month, business_unit, territory_name, dsp ORDER BY dist, tid) <= 21
)
SELECT month, business_unit, territory_name, dsp,
  greatest(0, CASE WHEN count(*) FILTER (WHERE dist = 0) > 0 THEN avg(y) FILTER (WHERE dist = 0)
                   ELSE sum(y / dist) FILTER (WHERE dist > 0) / sum(1 / dist) FILTER (WHERE dist > 0) END) AS pred
FROM near GROUP BY ALL
