-- Time columns and the previous ROW of each cohort (not the previous calendar month).
lagged AS (
  SELECT f.*,
    strftime(month, '%Y-%m') AS month_str,
    CAST(month(month) AS INTEGER) AS month_num,
    CAST(quarter(month) AS INTEGER) AS quarter,
    lag(total_gross_amount) OVER w AS gross_lag_1,
    lag(total_streams) OVER w AS streams_lag_1,
    lag(total_gross_amount) OVER w / nullif(lag(total_streams) OVER w, 0) AS epsr_lag_1
  FROM flagged f
  WINDOW w AS (PARTITION BY business_unit, territory_name, dsp ORDER BY month)
)
