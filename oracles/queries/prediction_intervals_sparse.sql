-- ctes: panel flagged lagged final_inputs nowcast_core intervals_min200
SELECT month, business_unit, territory_name, dsp, nowcast_pred, nowcast_lower_90, nowcast_upper_90 FROM scored
