-- ctes: panel flagged lagged backtest bt_inputs nowcast_core bt_models
SELECT model, mean, p50, p90,
  mean - (SELECT max(mean) FROM bt_summary WHERE model = 'EPSR') AS delta_vs_epsr,
  CAST(rank() OVER (ORDER BY mean, model) AS INTEGER) AS rank
FROM bt_summary
