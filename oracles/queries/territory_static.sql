-- ctes: panel
-- fixed values: the territory list must equal the reference's
SELECT country,
  CASE WHEN country IN ('Brazil', 'Canada', 'United States of America', 'Germany', 'United Kingdom',
                        'France', 'India', 'Australia', 'Mexico') THEN country
       ELSE 'All Other Locations' END AS territory_name,
  CAST(sum(total_streams) AS BIGINT) AS total_streams
FROM streams GROUP BY ALL
