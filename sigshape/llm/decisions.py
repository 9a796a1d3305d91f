"""Decisions of an operator, taken back to the rows they were made for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import saved, text_of

#: Rows that a decision touches, up to which their 64-bit marks are broadcast
#: (16 MB); more are joined by a shuffle.
MARKS = 2_000_000



def text_key(text: str | Column) -> Column:
    """What tells rows of one id (or of none) apart: a 64-bit hash of the text."""
    return F.xxhash64(text_of(text))


def _small(marks: DataFrame) -> DataFrame:
    return F.broadcast(marks) if marks.count() <= MARKS else marks


def drop_rows(docs: DataFrame, dropped: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              once: bool = False) -> DataFrame:
    """Rows of ``docs`` whose id and text are not in ``dropped`` (``doc_id``,
    and ``key`` as ``text_key`` gives it); all columns stay. With ``once``, one
    row of each id and text.

    What a decision keeps is nearly everything, so rows are matched with what
    it drops, and only rows of an id and text that stands more than once are
    numbered: whole rows are shuffled if there are over ``MARKS`` of those,
    and stay where they are otherwise. Whole rows travel in one struct, so no
    column name can clash; id and text go by one 64-bit mark.
    """
    mark = lambda i, key: F.xxhash64(F.col(i).isNull() if isinstance(i, str) else i.isNull(), i, key)
    gone = saved(dropped.select(mark("doc_id", F.col("key")).alias("of")).distinct(), "decision-gone")
    packed = docs.select(mark(docs[f"`{id_col}`"], text_key(text_col)).alias("mark"),
                         F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    if not once:
        return packed.join(_small(gone), F.col("mark") == F.col("of"), "left_anti").select("row.*")
    again = packed.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("mark").alias("of"))
    again = saved(again.join(gone.withColumnRenamed("of", "out"), F.col("of") == F.col("out"), "left_anti"), "decision-again")
    alone = packed.join(_small(saved(gone.unionByName(again), "decision-marks")), F.col("mark") == F.col("of"), "left_anti")
    copies = packed.join(_small(again), F.col("mark") == F.col("of"), "left_semi")
    first = Window.partitionBy("mark").orderBy(F.xxhash64("row"))
    copies = copies.withColumn("k", F.row_number().over(first)).where("k = 1")
    return alone.select("row.*").unionByName(copies.select("row.*"))
