-- Production run: train on clean known rows; score target/flag rows and, for
-- calibration, the train rows themselves (each set reconciles on its own).
nc_train AS (
  SELECT 'all' AS grp, * FROM lagged
  WHERE is_na = 0 AND is_zero = 0 AND total_streams > 0 AND quality_flag_low_revenue_high_streams = 0
),
nc_scored AS (
  SELECT 'all' AS grp, 'score' AS role, * FROM lagged
  WHERE is_na = 1 OR is_zero = 1 OR quality_flag_low_revenue_high_streams = 1
  UNION ALL
  SELECT grp, 'calib' AS role, * EXCLUDE (grp) FROM nc_train
)
