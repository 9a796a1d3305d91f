"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WHITE = "[\\x20\\x09-\\x0D]+"      # the white space of every contract here
CELL_ROWS = 50_000                # rows that one window partition sorts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(col: str | Column) -> Column:
    """The text, null counting as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is. Texts of ASCII
    alone take the fast path (there, both functions agree)."""
    return (F.when(F.octet_length(text) == F.char_length(text), F.lower(text))
            .otherwise(F.translate(text, UPPER, UPPER.lower())))


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Rows that no model learns from: crc32 of the id as text, mod 4, is 2."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 4 == 2, F.lit(False))


#: Removes the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, name: str, clean: bool = False) -> DataFrame:
    """``df`` written under ``spark.checkpoint.dir`` and read again: cuts the
    lineage, computes it once, and survives lost executors. ``clean``: the
    shuffle files that the table was made from go as soon as it is written, for
    shuffles as large as the input (Spark would keep them until the driver
    collects its garbage)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP) if clean else None
    if clean:
        spark.conf.set(CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        if clean:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


#: Texts of an Arrow batch that a Python worker decodes at once.
SLICE_ROWS = 256


def slices(batch):
    """An Arrow batch (or array) in slices of SLICE_ROWS; the memory that
    Arrow no longer needs is given back after the last one."""
    import pyarrow as pa

    for at in range(0, len(batch), SLICE_ROWS):
        yield batch.slice(at, SLICE_ROWS)
    pa.default_memory_pool().release_unused()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once (``addPyFile``), so that Python
    workers can import it wherever the driver found it."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="sigshape-"), "sigshape.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("sigshape", os.path.relpath(full, root)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def gapless_rank(df: DataFrame, group: str, cells: Column, salt: list[str], order: list[str],
                 rank: str = "rank") -> DataFrame:
    """``df`` with ``rank``: 0, 1, 2 ... within each ``group``, whatever its size.

    A group is dealt into ``cells`` cells by a hash of ``salt``; each cell is
    numbered on its own, and a cell's first rank is the number of rows in the
    cells before it. So no task sorts a whole group: the counts that are
    summed up over a group are one row per cell.
    """
    df = df.withColumn("_cell", F.pmod(F.xxhash64(*salt), cells.cast("bigint")))
    counts = df.groupBy(group, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(F.col(group).alias("_g"), F.col("_cell").alias("_c"),
                          F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    own = Window.partitionBy(group, "_cell").orderBy(*order)
    ranked = df.withColumn("_row", F.row_number().over(own).cast("bigint"))
    return (ranked.join(first, ranked[group].eqNullSafe(F.col("_g")) & (F.col("_cell") == F.col("_c")))
            .withColumn(rank, F.col("_row") - 1 + F.col("_first"))
            .drop("_g", "_c", "_cell", "_row", "_first"))
