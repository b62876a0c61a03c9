"""A pipeline over the documents: each stage applies one operator to all that its predecessor kept.

Toxic documents go; of each group of near-duplicates one document stays; documents that hold a passage of the benchmark go; secrets
are masked, and ``n_chars`` follows; the rest is encoded. All stages but the last return the columns of ``documents``, in their order.
Nulls, empty texts and repeated rows have the results that the operators state; a null text is kept unless a copy of it stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cif_lake.llm import bpe, decontaminate, secrets, simhash, toxicity
from cif_lake.llm.common import table, written


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a classifier, fitted on the labelled ones that aren't held out, does not reject."""
    return toxicity.remove(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"), held_out=toxicity.HELD_OUT))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least id, of each group of linked fingerprints."""
    return simhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of the benchmark occurs."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets that are not widely copied examples masked."""
    return secrets.redact(docs).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, their number, and whether they decode to the text."""
    both = bpe.public_tokenizer(spark).round_trip(docs.select("doc_id", "lang", "source", "text"))
    exact = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return both.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids", exact.alias("exact"))


STAGES = [
    ("toxicity", without_toxic),
    ("simhash near-dedup", without_near_duplicates),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("byte-level bpe", encoded),
]

#: The first stage is a trained model, which SQL can't express; tests/llm holds the stages against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; what a stage returns is written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{number}")
    return docs
