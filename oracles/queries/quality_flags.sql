-- ctes: panel flagged
SELECT month, business_unit, territory_name, dsp, quality_flag_low_revenue_high_streams FROM flagged
