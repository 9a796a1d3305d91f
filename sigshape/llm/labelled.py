"""Labelled rows that a classifier learns from, and a one-feature logistic fit."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, saved, text_of


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str, per_class: int,
                  id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, tuple[int, int]]:
    """(whole texts with ``label`` 0/1, numbers of labelled documents by class).

    Held-out rows never take part. Only labels of ids that ``docs`` has
    count; a document labelled more than once has its majority label, null
    labels do not count. An id is one row, that of the least text hash, however
    many rows it has. The numbers count every labelled document; the texts are
    those of at most ``per_class`` of each class, the first by a hash of the id
    (the documented bound of the fit), so their join is a broadcast of a
    proven size.
    """
    one = (labels.select(F.col(id_col).alias("labelled_id"), F.col(label_col).cast("int").alias("label"))
           .where(F.col("label").isin(0, 1) & F.col("labelled_id").isNotNull() & ~held_out("labelled_id"))
           .groupBy("labelled_id").agg((F.avg("label") >= 0.5).cast("int").alias("label")))
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    ids = rows.select("doc_id", F.xxhash64("text").alias("h")).groupBy("doc_id").agg(F.min("h").alias("h"))
    known = saved(ids.join(one, F.col("doc_id") == F.col("labelled_id")).select("labelled_id", "h", "label"), "labelled")
    counts = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = F.xxhash64("labelled_id")
    some = None
    for k in (0, 1):
        part = known.where(F.col("label") == k).orderBy(order, "labelled_id").limit(per_class)
        some = part if some is None else some.unionByName(part)
    some = some.withColumnRenamed("h", "of")
    rows = rows.join(F.broadcast(some), (F.col("doc_id") == F.col("labelled_id")) & (F.xxhash64("text") == F.col("of")))
    rows = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))
    return rows.select("doc_id", "text", "label"), (counts.get(0, 0), counts.get(1, 0))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """(intercept, slope) of a weighted logistic regression by Newton steps."""
    design = np.stack([np.ones_like(x), x], 1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (weight * (y - p)) - ridge * beta
        hess = (design * (weight * p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def class_weights(y: np.ndarray, counts: tuple[int, int]) -> np.ndarray:
    """Weights that give a bounded sample the class shares of all labelled rows."""
    have = np.bincount(y.astype(int), minlength=2)
    share = np.array(counts, float) / max(1, sum(counts))
    return (share / np.maximum(have, 1) * len(y))[y.astype(int)]
