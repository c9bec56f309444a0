-- ctes: panel flagged lagged backtest holdout_inputs nowcast_core
SELECT 'Lag-Aware Hierarchical Nowcast' AS model, count(*) AS rows,
  CAST(sum(CAST(CAST(abs(total_gross_amount - nowcast_pred) AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) / count(*) AS mae,
  CAST(sum(CAST(CAST(abs(total_gross_amount - nowcast_pred) AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE)
    / nullif(CAST(sum(CAST(CAST(abs(total_gross_amount) AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE), 0) AS wmape
FROM nowcast WHERE role = 'score'
