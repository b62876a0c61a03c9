"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration.

The statistics of all documents are computed once and written. Each partition of the labelled ones sums its part of the normal
equations with numpy; the sums are added up by matrix cell, so the driver gets one matrix of a fixed size and solves it. The
calibration is fitted on a histogram of the scores of all training rows, of ``BINS`` bins.

Defined results: a null or empty text has zero statistics and gets the score of such a text; without labels every score is one
half. A repeated id is learned as often as it occurs. Result columns replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cif_lake.llm import boosting
from cif_lake.llm.common import arrow_function, remainder, ship, table, text_function, written
from cif_lake.llm.labelled import labels
from cif_lake.llm.statistics import FEATURES, statistics

#: Random features, the kernel's width in standard deviations, the ridge, bins of the calibration.
WAVES, WIDTH, RIDGE, BINS, SEED = 128, 3.0, 1e-3, 1000, 7
THRESHOLD = 0.7
HELD_OUT = (4, 2)


@dataclass
class Kernel:
    """cos(Wx + b) over standardised statistics, whose products approximate a Gaussian kernel; a constant last."""

    mean: np.ndarray
    scale: np.ndarray
    waves: np.ndarray
    phase: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        waves = np.sqrt(2 / len(self.phase)) * np.cos(z @ self.waves + self.phase)
        return np.concatenate([waves, np.ones((len(x), 1))], axis=1)


def kernel(mean: np.ndarray, scale: np.ndarray, waves: int = WAVES, width: float = WIDTH, seed: int = SEED) -> Kernel:
    draw = np.random.default_rng(seed)
    return Kernel(mean, scale, draw.standard_normal((len(mean), waves)) / width, draw.uniform(0, 2 * np.pi, waves))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), float).reshape(-1, width)


def described(documents: DataFrame, text: str = "text", name: str = "x") -> DataFrame:
    """Documents with the features of their text in an array."""
    return documents.withColumn(name, text_function(lambda: lambda texts: [statistics(t)[1] for t in texts], "array<double>")(text))


def normal_equations(rows: DataFrame, phi: Kernel) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``phi(x) phi(x)^T`` and ``phi(x) y`` over all rows ``(x, y)``."""
    n = len(phi.phase) + 1
    ship()

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n, n + 1))
        for batch in batches:
            z = phi(matrix(batch.column(0), len(phi.mean)))
            total += z.T @ np.concatenate([z, np.asarray(batch.column(1), float)[:, None]], axis=1)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(n * (n + 1), dtype=np.int32)), pa.array(total.ravel())], ["cell", "v"])

    cells = rows.select("x", "y").mapInArrow(partial, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect()
    total = np.zeros(n * (n + 1))
    for r in cells:
        total[r["cell"]] = r["v"]
    total = total.reshape(n, n + 1)
    return total[:, :n], total[:, n]


@dataclass
class Model:
    phi: Kernel
    weights: np.ndarray
    points: tuple[np.ndarray, np.ndarray]

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.phi(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return boosting.calibrated(self.points, self.raw(x))


def fit(rows: DataFrame, waves: int = WAVES, ridge: float = RIDGE) -> Model:
    """Fit on all rows ``(x, y)``."""
    d = len(FEATURES)
    moments = rows.agg(F.count("*"), *(F.sum(F.col("x")[k]) for k in range(d)), *(F.sum(F.col("x")[k] * F.col("x")[k]) for k in range(d))).first()
    count = moments[0]
    if not count:
        return Model(kernel(np.zeros(d), np.ones(d), waves), np.zeros(waves + 1), (np.array([0.0]), np.array([0.5])))
    mean = np.array(moments[1 : d + 1], float) / count
    spread = np.sqrt(np.maximum(np.array(moments[d + 1 :], float) / count - mean**2, 0))
    phi = kernel(mean, np.where(spread > 1e-9, spread, 1.0), waves)
    a, b = normal_equations(rows, phi)
    weights = np.linalg.solve(a + ridge * count / len(a) * np.eye(len(a)), b)
    model = Model(phi, weights, (np.array([0.0]), np.array([0.5])))
    shared = rows.sparkSession.sparkContext.broadcast(model)
    bins = rows.select("y", F.floor(F.least(F.greatest(_scorer(shared, "raw")("x"), F.lit(-1.0)), F.lit(2.0)) * BINS).alias("bin"))
    histogram = bins.groupBy("bin").agg(F.sum("y").alias("y"), F.count("*").alias("n")).collect()
    s, y, n = (np.array([r[c] for r in histogram], float) for c in ("bin", "y", "n"))
    model.points = boosting.isotonic((s + 0.5) / BINS, y / n, n)
    return model


def _scorer(shared, method: str):
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for column in columns:
            yield pa.array(getattr(model, method)(matrix(column, len(model.phi.mean))))

    return arrow_function(run, "double")


def apply(described_documents: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """Documents that have their statistics in ``x``, with the calibrated probability of good quality."""
    return described_documents.withColumn(name, _scorer(described_documents.sparkSession.sparkContext.broadcast(model), "score")("x"))


def op10(spark, sf_dir: str) -> DataFrame:
    """Score of every document, learned without the held-out labels."""
    documents = written(described(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text"), "statistics")
    model = fit(documents.join(labels(table(spark, sf_dir, "labels"), "quality", held_out=HELD_OUT), "doc_id").select("x", "y"))
    held = F.coalesce(remainder("doc_id", HELD_OUT[0]) == HELD_OUT[1], F.lit(False))
    return apply(documents, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
