"""Monitoring of tabular data that arrives in calendar-month batches, on Spark.

Every operator takes and returns DataFrames and works on all batches at once.
"""
