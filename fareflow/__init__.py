"""fareflow: trip-and-fare analytics on PySpark.

Raw trip CSV files go in under a strict schema, land exactly once in a Parquet
lake partitioned by year and month, and come out as daily statistics and a
linear fare model. Everything is a function from DataFrame to DataFrame; no
module opens a session of its own.
"""

__version__ = "0.1.0"
