-- ctes: panel flagged lagged final_inputs nowcast_core intervals final audit
SELECT * FROM reliability
