-- ctes: panel flagged lagged backtest bt_inputs nowcast_core bt_models
SELECT * FROM bt_overall
