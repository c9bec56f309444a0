-- ctes: panel flagged lagged backtest bt_inputs nowcast_core bt_models
WITH ref AS (SELECT max(mean) AS rm, max(p90) AS rp90 FROM bt_summary WHERE model = 'EPSR'),
months AS (
  SELECT model, count(*) FILTER (WHERE pred IS NULL) AS none,
    CAST(sum(CAST(CAST(abs(total_gross_amount - pred) AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE)
    / nullif(CAST(sum(CAST(CAST(abs(total_gross_amount) AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE), 0) AS w
  FROM bt_preds GROUP BY model, repeat, month),
worst AS (SELECT model, max(w) AS w, sum(none) AS none FROM months GROUP BY model),
totals AS (
  SELECT model, min(t) AS low, max(t) AS high FROM (
    SELECT model, CAST(sum(CAST(CAST(pred AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE) / nullif(CAST(sum(CAST(CAST(total_gross_amount AS VARCHAR) AS DECIMAL(38,15))) AS DOUBLE), 0) AS t
    FROM bt_preds GROUP BY model, repeat) GROUP BY model),
gate AS (
  SELECT s.model, mean < rm AS beats_mean, p90 <= rp90 * (1 + 0.05) AS p90_ok,
    none = 0 AND w.w <= (SELECT w FROM worst WHERE model = 'EPSR') * (1 + 0.5) AS stable,
    low >= 0.85 AND high <= 1.15 AS coherent
  FROM bt_summary s CROSS JOIN ref JOIN worst w USING (model) JOIN totals USING (model))
SELECT *, beats_mean AND p90_ok AND stable AND coherent AND model <> 'EPSR' AS promote FROM gate
