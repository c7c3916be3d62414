"""Queries over the test tables, each with the SQL that states the expected result."""
