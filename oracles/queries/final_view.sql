-- ctes: panel flagged lagged final_inputs nowcast_core intervals final
SELECT * FROM final_view
