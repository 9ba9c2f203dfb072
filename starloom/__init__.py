"""starloom: warehouse-building operators for PySpark.

Every operator is a plain function from DataFrames to a DataFrame.  Only
``sources.sinks`` and ``plans.warehouse`` write anything.
"""
