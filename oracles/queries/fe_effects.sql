-- ctes: panel flagged
SELECT 'global' AS level, CAST(NULL AS VARCHAR) AS key, mu AS mean_z, CAST(NULL AS BIGINT) AS n FROM fe_global
UNION ALL SELECT 'territory', territory_name, t_mean, t_n FROM fe_territory
UNION ALL SELECT 'dsp', dsp, d_mean, d_n FROM fe_dsp
