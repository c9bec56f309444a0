-- ctes: panel flagged lagged final_inputs nowcast_core
SELECT 'cohort' AS level, business_unit, territory_name, dsp, r AS rate FROM nc_rate_cohort
UNION ALL SELECT 'territory_dsp', NULL, territory_name, dsp, r FROM nc_rate_td
UNION ALL SELECT 'dsp', NULL, NULL, dsp, r FROM nc_rate_dsp
UNION ALL SELECT 'global', NULL, NULL, NULL, r FROM nc_rate_global
