"""Labelled rows for the classifiers, and splits by document id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cif_lake.llm.common import remainder

#: Labelled documents that a classifier is fitted on at most; they are drawn by a hash of their id.
TRAIN_ROWS = 20_000


def labels(rows: DataFrame, label: str, doc_id: str = "doc_id", held_out: tuple[int, int] | None = None) -> DataFrame:
    """One row ``(doc_id, y)`` per id; ids that are null, without a label, labelled in two ways or held out (n, remainder) are left out."""
    if held_out:
        rows = rows.where(remainder(doc_id, held_out[0]) != held_out[1])
    one = rows.groupBy(F.col(doc_id).alias("doc_id")).agg(F.min(label).cast("double").alias("y"), F.max(label).cast("double").alias("most"))
    return one.where("doc_id IS NOT NULL AND y = most").drop("most")


def bounded(rows: DataFrame, bound: int = TRAIN_ROWS) -> DataFrame:
    """At most ``bound`` rows of ``labels``, drawn by a hash of the id: a frame that may be broadcast."""
    parts = 1 << 20
    count = rows.count()
    if count > bound:
        rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(parts)) < int(parts * bound / count * 0.97))
    return F.broadcast(rows.limit(bound))


def training(documents: DataFrame, sample: DataFrame, features, text: str = "text", doc_id: str = "doc_id"):
    """Features and labels, as two numpy arrays, of the documents in a bounded sample; a repeated id counts once."""
    import numpy as np

    found = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(sample, "doc_id")
    rows = found.select("doc_id", "y", features("text").alias("x")).groupBy("doc_id").agg(F.min("y").alias("y"), F.min("x").alias("x")).orderBy("doc_id").collect()
    x = np.array([r["x"] for r in rows], float) if rows else np.zeros((0, 0))
    return x, np.array([r["y"] for r in rows], float)
