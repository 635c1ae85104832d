"""bourse: market analytics for daily price series on Apache Spark.

Every operator maps DataFrames to DataFrames and is built from Spark's own
expressions, so Catalyst sees whole plans from the file scan to the report.
"""
