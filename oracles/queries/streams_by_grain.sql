-- ctes: panel
SELECT * FROM streams_agg
