"""Usage analytics as PySpark DataFrame functions.

sources    tables, the fixture views, the log table, the shared folder
operators  what Spark has no single call for: global numbering, page nodes, pivot, ...
functions  column expressions and the functions that run inside tasks
plans      the sales queries and the usage reports, from DataFrames to DataFrame
"""
