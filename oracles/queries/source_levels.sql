-- ctes: panel
SELECT 'revenue' AS table_name, 'business_unit' AS column_name, business_unit AS value FROM revenue
UNION SELECT 'revenue', 'territory_name', territory_name FROM revenue
UNION SELECT 'revenue', 'dsp', dsp FROM revenue
UNION SELECT 'streams', 'business_unit', business_unit FROM streams
UNION SELECT 'streams', 'country', country FROM streams
UNION SELECT 'streams', 'dsp', dsp FROM streams
