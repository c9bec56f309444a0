-- ctes: panel
SELECT * FROM revenue_agg
