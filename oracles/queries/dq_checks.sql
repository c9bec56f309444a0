-- ctes: panel
WITH chk AS (
  SELECT
    (SELECT count(*) FROM panel WHERE month IS NULL OR business_unit IS NULL
       OR territory_name IS NULL OR dsp IS NULL) AS null_dimension_rows,
    (SELECT CAST(sum(CAST(CAST(total_gross_amount AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) FROM revenue) AS source_revenue,
    (SELECT CAST(sum(total_streams) AS BIGINT) FROM streams) AS source_streams,
    (SELECT CAST(sum(CAST(CAST(total_gross_amount AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) FROM panel) AS final_revenue,
    (SELECT CAST(sum(total_streams) AS BIGINT) FROM panel) AS final_streams
)
SELECT null_dimension_rows,
  CASE WHEN null_dimension_rows = 0 THEN 'PASS' ELSE 'FAIL' END AS dimension_check,
  CASE WHEN abs(source_revenue - final_revenue) <= 1e-9 * greatest(abs(source_revenue), 1.0)
       THEN 'PASS' ELSE 'FAIL' END AS revenue_total_check,
  CASE WHEN source_streams = final_streams THEN 'PASS' ELSE 'FAIL' END AS streams_total_check,
  source_streams, final_streams, source_revenue, final_revenue
FROM chk
