"""Operators for preparing training data.  Nothing outside this package imports it.

Every operator takes DataFrames and returns DataFrames; ``queries`` holds one query per
operator over the given tables and the SQL for those that SQL can express.
"""
