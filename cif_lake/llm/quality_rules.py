"""Quality rules: gradient-boosted trees over document statistics, with monotonic constraints on the junk rates.

The trees are trained on a bounded sample of labelled documents (``labelled.TRAIN_ROWS``), flattened to numpy node arrays, broadcast
(their size is fixed by the number and depth of the trees) and evaluated for a slice of documents at a time. A document that fails
a fixed rule is not kept whatever the trees say.

Defined results: a null or empty text has zero words, so it fails; without labels of both classes the trees give the share of
good labels, or one half. Result columns replace input columns of the same name.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cif_lake.llm import boosting
from cif_lake.llm.common import aside, table, text_function
from cif_lake.llm.labelled import TRAIN_ROWS, bounded, labels, training
from cif_lake.llm.statistics import COUNTS, FEATURES, statistics

#: Documents with a lower probability of being good are not kept.
KEEP = 0.5
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


def fit(documents: DataFrame, rows: DataFrame, label: str = "quality", bound: int = TRAIN_ROWS, **options) -> boosting.Forest:
    """Trees for the label, never rising with a feature that ``FEATURES`` marks."""
    features = text_function(lambda: lambda texts: [statistics(t)[1] for t in texts], "array<double>")
    x, y = training(documents, bounded(labels(rows, label), bound), features)
    return boosting.train(x.reshape(len(y), len(FEATURES)), y, np.array(list(FEATURES.values())), **options)


def apply(documents: DataFrame, forest: boosting.Forest, text: str = "text", keep: float = KEEP) -> DataFrame:
    """Documents with the counts, ``base_failed``, the trees' ``good`` probability, and ``kept``."""
    shared = documents.sparkSession.sparkContext.broadcast(forest)

    def make():
        model = shared.value

        def run(texts):
            found = [statistics(t) for t in texts]
            good = model.probability(np.array([f for _, f in found], float).reshape(len(found), len(FEATURES)))
            return [dict(zip([*COUNTS, "good"], [*c, float(g)], strict=True)) for (c, _), g in zip(found, good, strict=True)]

        return run

    schema = "struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ",good:double>"
    documents, now, back = aside(documents, "_rules")
    out = documents.withColumn("_rules", text_function(make, schema)(now(text)))
    out = out.withColumns({c: F.col(f"_rules.{c}") for c in [*COUNTS, "good"]})
    failed = (F.col("_rules.n_words") < MIN_WORDS) | (100 * F.col("_rules.n_repeat_words") > MAX_REPEAT_PERCENT * F.col("_rules.n_words"))
    return back(out.withColumns({"base_failed": failed, "kept": ~failed & (F.col("_rules.good") >= keep)}).drop("_rules"))


def op2(spark, sf_dir: str) -> DataFrame:
    """Counts and verdict for every document."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    forest = fit(documents, table(spark, sf_dir, "labels"))
    return apply(documents, forest).select("doc_id", *COUNTS, "base_failed", "kept", "good")
