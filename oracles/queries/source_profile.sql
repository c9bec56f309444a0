-- ctes: panel
WITH rev AS (SELECT month, business_unit, territory_name, dsp, total_gross_amount FROM revenue),
rc AS (
  SELECT count(*) AS rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM rev)) AS duplicate_rows,
    count(*) - count(month) AS month, count(*) - count(business_unit) AS business_unit,
    count(*) - count(territory_name) AS territory_name, count(*) - count(dsp) AS dsp,
    count(*) - count(total_gross_amount) AS total_gross_amount
  FROM rev
),
sc AS (
  SELECT count(*) AS rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM streams)) AS duplicate_rows,
    count(*) - count(month) AS month, count(*) - count(business_unit) AS business_unit,
    count(*) - count(country) AS country, count(*) - count(dsp) AS dsp,
    count(*) - count(total_streams) AS total_streams
  FROM streams
)
SELECT 'revenue' AS table_name, column_name, rows, nulls, duplicate_rows
FROM (UNPIVOT rc ON month, business_unit, territory_name, dsp, total_gross_amount INTO NAME column_name VALUE nulls)
UNION ALL
SELECT 'streams', column_name, rows, nulls, duplicate_rows
FROM (UNPIVOT sc ON month, business_unit, country, dsp, total_streams INTO NAME column_name VALUE nulls)
