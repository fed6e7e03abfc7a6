"""Query plans over the test tables, one function a query, with the SQL that states the same result."""
