-- ctes: panel
SELECT dsp AS raw_dsp, family AS dsp,
  CAST(sum(CAST(CAST(total_gross_amount AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) AS total_gross_amount
FROM revenue GROUP BY dsp, family
