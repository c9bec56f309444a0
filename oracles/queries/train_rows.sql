-- ctes: panel flagged
SELECT month, business_unit, territory_name, dsp, total_streams, total_gross_amount
FROM flagged
WHERE is_na = 0 AND is_zero = 0 AND total_streams > 0 AND quality_flag_low_revenue_high_streams = 0
