-- ctes: panel flagged lagged final_inputs nowcast_core intervals final audit
SELECT * FROM rule_b WHERE coalesce(abs(robust_z_dsp) > 4.5, false)
