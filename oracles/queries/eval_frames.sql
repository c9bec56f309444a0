-- ctes: panel flagged lagged backtest
SELECT month_str, count(*) AS rows,
  count(*) FILTER (WHERE is_na = 0 AND is_zero = 0 AND total_streams > 0) AS known_all,
  count(*) FILTER (WHERE is_na = 0 AND is_zero = 0 AND total_streams > 0
                   AND month_str NOT IN (SELECT month_str FROM bt_excluded)) AS known_eval,
  count(*) FILTER (WHERE is_na = 1 OR is_zero = 1) AS target_rows
FROM lagged GROUP BY month_str
