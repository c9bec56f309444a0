-- ctes: panel
SELECT * FROM panel
