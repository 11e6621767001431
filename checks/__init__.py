"""Metric roles over the given test tables, and the SQL every registered query is compared with."""
