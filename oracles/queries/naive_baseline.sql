-- ctes: panel flagged lagged backtest
SELECT month, business_unit, territory_name, dsp, gross_lag_1 AS pred FROM bt_pool WHERE gross_lag_1 IS NOT NULL
