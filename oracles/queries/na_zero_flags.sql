-- ctes: panel
SELECT month, count(*) AS rows, CAST(sum(is_na) AS BIGINT) AS is_na, CAST(sum(is_zero) AS BIGINT) AS is_zero
FROM panel GROUP BY month
