-- ctes: panel
SELECT DISTINCT 'business_unit' AS column_name, business_unit AS value FROM panel
UNION SELECT DISTINCT 'territory_name', territory_name FROM panel
UNION SELECT DISTINCT 'dsp', dsp FROM panel
