-- Backtest fits: train = pool minus the holdout rows, scored = the holdout rows; grp = repeat.
nc_train AS (SELECT repeat AS grp, * EXCLUDE (repeat, skey) FROM bt_train),
nc_scored AS (SELECT repeat AS grp, 'score' AS role, * EXCLUDE (repeat, skey) FROM bt_test)
