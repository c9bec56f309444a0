-- ctes: panel flagged lagged backtest bt_inputs nowcast_core bt_models
SELECT model, repeat, month, count(*) AS rows, CAST(sum(CAST(CAST(abs(total_gross_amount - pred) AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) / count(*) AS mae,
  CAST(sum(CAST(CAST(abs(total_gross_amount - pred) AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE)
    / nullif(CAST(sum(CAST(CAST(abs(total_gross_amount) AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE), 0) AS wmape,
  CAST(sum(CAST(CAST(abs(total_gross_amount - pred) AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) AS abs_error_sum,
  CAST(sum(CAST(CAST(abs(total_gross_amount) AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) AS abs_actual_sum
FROM bt_preds GROUP BY model, repeat, month
