-- ctes: panel flagged lagged final_inputs nowcast_core intervals final audit
WITH f AS (
  SELECT b.month, b.business_unit, b.territory_name, b.dsp,
    CASE WHEN coalesce(abs(b.robust_z_dsp) > 4.5, false) THEN 1 ELSE 0 END AS rule_b,
    CASE WHEN j.jr < 0.1 OR j.jr > 10.0 THEN 1 ELSE 0 END AS rule_c,
    CASE WHEN b.rps < q.lo OR b.rps > q.hi THEN 1 ELSE 0 END AS rule_d,
    CASE WHEN b.filled_revenue <= 1.0 AND b.total_streams > 1000000 THEN 1 ELSE 0 END AS rule_tiny
  FROM rule_b b
  JOIN jumps j ON b.month = j.month AND b.business_unit = j.business_unit
   AND b.territory_name = j.territory_name AND b.dsp = j.dsp
  CROSS JOIN rd_q q
)
SELECT *, rule_b + rule_c + rule_d + rule_tiny AS n_flags,
  CASE WHEN rule_b + rule_c + rule_d + rule_tiny >= 2 THEN 'quarantine'
       WHEN rule_b + rule_c + rule_d + rule_tiny = 1 THEN 'down_weight' ELSE 'normal' END AS severity
FROM f
