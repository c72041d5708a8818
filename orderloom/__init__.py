"""orderloom: retail order operations on Spark DataFrames.

Landed pages of nested documents become typed tables, tables are appended to
or upserted by key, and a set of reports is computed over them.
"""
