-- ctes: panel flagged lagged
SELECT month, business_unit, territory_name, dsp, gross_lag_1, streams_lag_1, epsr_lag_1 FROM lagged
