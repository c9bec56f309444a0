-- ctes: panel flagged lagged final_inputs nowcast_core intervals final audit
SELECT v.*, CASE WHEN v.rps < q.lo THEN 'low' ELSE 'high' END AS tail
FROM valid_final v CROSS JOIN rd_q q
WHERE v.rps < q.lo OR v.rps > q.hi
