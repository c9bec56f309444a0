-- ctes: panel
SELECT CASE WHEN s.month IS NOT NULL AND r.month IS NOT NULL THEN 'both'
            WHEN s.month IS NOT NULL THEN 'streams_only' ELSE 'revenue_only' END AS side,
       count(*) AS rows
FROM streams_agg s
FULL OUTER JOIN revenue_agg r
  ON s.month = r.month AND s.business_unit = r.business_unit
 AND s.territory_name = r.territory_name AND s.dsp = r.dsp
GROUP BY 1
