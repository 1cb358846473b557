"""siltstone: lakehouse quality and analytics operators for PySpark.

Every capability is a DataFrame -> DataFrame (or Column -> Column) function built from native Spark
expressions, joins, aggregates, windows and Structured Streaming.
"""
