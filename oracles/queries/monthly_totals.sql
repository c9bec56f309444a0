-- ctes: panel
SELECT 'dsp' AS dimension, dsp AS value, month,
  CAST(sum(CAST(CAST(total_gross_amount AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) AS total_gross_amount,
  CAST(sum(total_streams) AS BIGINT) AS total_streams
FROM panel GROUP BY dsp, month
UNION ALL
SELECT 'territory_name', territory_name, month,
  CAST(sum(CAST(CAST(total_gross_amount AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE),
  CAST(sum(total_streams) AS BIGINT)
FROM panel GROUP BY territory_name, month
