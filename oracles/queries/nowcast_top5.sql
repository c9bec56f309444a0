-- ctes: panel flagged lagged final_inputs nowcast_core intervals final
SELECT * FROM final_view WHERE value_status = 'nowcasted'
ORDER BY month, business_unit, territory_name, dsp LIMIT 5
