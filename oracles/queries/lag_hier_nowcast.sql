-- ctes: panel flagged lagged final_inputs nowcast_core
SELECT month, business_unit, territory_name, dsp, anchor_pred, nowcast_pred FROM nowcast WHERE role = 'score'
