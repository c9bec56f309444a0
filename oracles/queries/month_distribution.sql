-- ctes: panel flagged lagged backtest
SELECT * FROM bt_plan
