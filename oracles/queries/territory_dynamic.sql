-- ctes: panel
SELECT country, territory_name, CAST(sum(total_streams) AS BIGINT) AS total_streams
FROM streams_std GROUP BY country, territory_name
