"""sigshape: shaping delimited message streams and landed record tables on Spark.

Every operator is a DataFrame -> DataFrame function built from Spark SQL
expressions. Row-wise operators run unchanged on streaming DataFrames;
per-batch operators (dedup) run inside ``foreachBatch``.
"""

__version__ = "0.1.0"
