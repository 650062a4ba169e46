"""tocsin: incident analytics on Spark, batch and streaming.

Operators take and return DataFrames and are lazy unless their name says that
they write. Everything runs as built-in Spark expressions; there is no UDF.
"""
