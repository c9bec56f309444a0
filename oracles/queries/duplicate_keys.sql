-- ctes: panel
SELECT month, business_unit, territory_name, dsp, count(*) AS rows
FROM panel GROUP BY ALL HAVING count(*) > 1
