"""Operators of a training-data pipeline over a ``documents`` table.

Nothing else in the library imports this subpackage. Every operator takes
DataFrames and column names, keeps hot keys split, and cuts lineage only
through tables written under ``spark.checkpoint.dir``.
"""
