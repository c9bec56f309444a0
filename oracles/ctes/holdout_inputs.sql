-- Time holdout: train before the latest pool month, score the latest month.
nc_train AS (
  SELECT 'h' AS grp, * FROM bt_pool WHERE month < (SELECT max(month) FROM bt_pool)
),
nc_scored AS (
  SELECT 'h' AS grp, 'score' AS role, * FROM bt_pool WHERE month = (SELECT max(month) FROM bt_pool)
)
