"""Table operators on Spark: extract, batch, transform, load, stage and refresh.

Every operator takes and returns Spark DataFrames (or table names) and leaves the
planning to Catalyst.  See README.md for the list.
"""
