-- ctes: panel flagged lagged backtest
SELECT repeat, month, business_unit, territory_name, dsp FROM bt_test
