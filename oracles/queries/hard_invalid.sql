-- ctes: panel flagged lagged final_inputs nowcast_core intervals final audit
SELECT month, business_unit, territory_name, dsp, total_streams, filled_revenue FROM robust WHERE hard_invalid
