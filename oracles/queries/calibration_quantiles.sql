-- ctes: panel flagged lagged final_inputs nowcast_core intervals
SELECT q.territory_name, q.dsp, q.n AS group_n, q.q AS group_q, g.gq AS global_q
FROM pi_group q CROSS JOIN pi_global g
