-- ctes: panel flagged lagged backtest
WITH th AS (SELECT *, month = (SELECT max(month) FROM bt_pool) AS is_val FROM bt_pool)
SELECT 'train' AS split, count(*) AS rows, min(month) AS first_month, max(month) AS last_month
FROM th WHERE NOT is_val
UNION ALL
SELECT 'validation', count(*), min(month), max(month) FROM th WHERE is_val
