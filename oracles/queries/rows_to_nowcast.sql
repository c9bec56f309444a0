-- ctes: panel flagged
SELECT month, business_unit, territory_name, dsp, is_na, is_zero, quality_flag_low_revenue_high_streams
FROM flagged WHERE is_na = 1 OR is_zero = 1 OR quality_flag_low_revenue_high_streams = 1
