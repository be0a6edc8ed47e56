"""Take mixed JSON event streams apart into typed tables and outgoing messages, on Spark.

Every operator is a function from DataFrame to DataFrame.  Those that work record by record
(decode, project, route, label, encode) run unchanged on batch and streaming DataFrames.
"""
