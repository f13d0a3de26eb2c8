"""firmlens: text-to-technology firm analytics as Spark DataFrame jobs.

Every operator takes DataFrames and returns a DataFrame, so it composes with
``df.transform``. Nothing here runs a job on the data unless its docstring says so.
"""
