"""Episode-of-care analytics on claims line items, written for Spark.

Every operator takes a DataFrame and returns one, with column names as
parameters, so the same code runs on a claims table or on any table of that
shape.
"""
