-- ctes: panel
SELECT strftime(month, '%Y-%m') AS month_str, count(*) AS total_rows,
  count(*) FILTER (WHERE is_na = 1 OR is_zero = 1) AS target_rows,
  (count(*) FILTER (WHERE is_na = 1 OR is_zero = 1)) / count(*) AS target_share
FROM panel GROUP BY 1
