-- ctes: panel flagged lagged final_inputs nowcast_core intervals final
SELECT month, business_unit, territory_name, dsp, rps FROM final_view
