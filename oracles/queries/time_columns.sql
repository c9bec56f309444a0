-- ctes: panel flagged lagged
SELECT month, business_unit, territory_name, dsp, month_str, month_num, quarter FROM lagged
