-- ctes: panel flagged lagged final_inputs nowcast_core
SELECT month, business_unit, territory_name, dsp, nowcast_pred, guardrail_applied FROM nowcast WHERE role = 'score'
