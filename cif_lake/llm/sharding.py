"""Sharding by sampled splitters.

Records are ordered by a hash of their text, equal texts next to each other, then by a hash of their id. A sample in which a record
is the likelier the larger it is gives splitters at its quantiles; records are range-partitioned by them, and what a range holds is
measured. A range that holds over twice its share is subdivided by splitters from a denser sample of its own records. Inside a
range, sizes are summed up in order; with the sums of the ranges before, each record knows the bytes in front of it, and its shard.

Shards are filled by bytes. Records with one text are kept in one shard as long as they hold ``SLACK`` of a shard at most; larger
groups are cut between records. A record or group belongs to the shard that its middle falls into.

Only the id, the size and the hashes are shuffled. What the driver holds is the sample and one row per range, both bounded by the
number of ranges. Rows that are equal in text and id can't be told apart by the order; they are one record with a count until their
slots are dealt.

Defined results: a null text has size ``OVERHEAD`` and the checksum of nothing; null ids come first among equal texts; no rows
give no shards. Columns beyond the id and the text are not carried.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cif_lake.llm.common import arrow_function, checkpointed, table

SHARDS, OVERHEAD, SLACK = 40, 16, 0.05
#: Sampled records per splitter, bytes of records that a range holds about, and the least number of ranges.
SAMPLE, RANGE_BYTES, LEAST_RANGES = 50, 256 << 20, 64
#: A range that holds this many times its share is subdivided, a few times at most.
OVERFULL, ROUNDS = 2.0, 4


def records(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, size, text_crc32, k1, k2, n)``: one row for each different id and text, with its number of rows."""
    raw = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    rows = documents.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(raw) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.xxhash64(raw, F.lit(SHARDS)).alias("k1"),
        F.xxhash64(F.col(doc_id).cast("string")).alias("k2"),
    )
    return rows.groupBy("doc_id", "size", "text_crc32", "k1", "k2").agg(F.count("*").alias("n"))


def _sampled(rows: DataFrame, rate: float) -> list[tuple[int, int, float]]:
    """Keys of records drawn with a probability of ``rate`` a byte, at most one, and the bytes each stands for."""
    bytes_ = (F.col("size") * F.col("n")).cast("double")
    draw = F.pmod(F.xxhash64("k1", "k2", F.lit("draw")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = rows.where(draw < bytes_ * rate).select("k1", "k2", F.greatest(bytes_, F.lit(1 / rate)).alias("w"))
    return [(r["k1"], r["k2"], r["w"]) for r in chosen.collect()]


def _quantiles(sample: list[tuple[int, int, float]], ranges: int) -> list[tuple[int, int]]:
    sample.sort()
    total = np.cumsum([w for _, _, w in sample])
    at = np.searchsorted(total, np.arange(1, ranges) * (total[-1] / ranges)) if len(sample) else []
    return sorted({sample[min(int(i), len(sample) - 1)][:2] for i in at})


def _ranged(splitters: list[tuple[int, int]]):
    """The number of splitters at or below a key: its range."""
    first = np.array([s[0] for s in splitters], np.int64)
    second = np.array([s[1] for s in splitters], np.int64)

    def run(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for k1, k2 in columns:
            a, b = (np.asarray(k.to_numpy(zero_copy_only=False), np.int64) for k in (k1, k2))
            low, high = np.searchsorted(first, a, "left"), np.searchsorted(first, a, "right")
            out = low.astype(np.int32)
            for i in np.flatnonzero(high > low):
                out[i] = low[i] + np.searchsorted(second[low[i] : high[i]], b[i], "right")
            yield pa.array(out)

    return arrow_function(run, "int")


def split(rows: DataFrame, ranges: int, total: int) -> DataFrame:
    """Records with their ``range``; ranges that are found overfull are subdivided."""
    rate = SAMPLE * ranges / max(1, total)
    splitters = _quantiles(_sampled(rows, rate), ranges)
    for _ in range(ROUNDS):
        placed = rows.withColumn("range", _ranged(splitters)("k1", "k2"))
        held = {r["range"]: (r["b"], r["keys"]) for r in placed.groupBy("range").agg(F.sum(F.col("size") * F.col("n")).alias("b"), F.count("*").alias("keys")).collect()}
        full = {k: math.ceil(b * ranges / total) for k, (b, keys) in held.items() if keys > 1 and b > OVERFULL * total / ranges}
        if not full:
            break
        rate *= 4
        inside = placed.where(F.col("range").isin(list(full)))
        by_range: dict[int, list] = {}
        for key in _sampled(inside, rate):
            by_range.setdefault(_place(splitters, key[:2]), []).append(key)
        finer = sorted({*splitters, *(s for k, sample in by_range.items() for s in _quantiles(sample, full[k]))})
        if finer == splitters:
            break
        splitters = finer
    return rows.withColumn("range", _ranged(splitters)("k1", "k2"))


def _place(splitters: list[tuple[int, int]], key: tuple[int, int]) -> int:
    from bisect import bisect_right

    return bisect_right(splitters, key)


def assign(documents: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)`` for every row."""
    rows = checkpointed(records(documents, doc_id, text))
    total = rows.agg(F.sum(F.col("size") * F.col("n"))).first()[0] or 0
    ranges = max(LEAST_RANGES, math.ceil(total / RANGE_BYTES))
    placed = checkpointed(split(rows, ranges, total).repartition("range"))
    bytes_ = F.col("size") * F.col("n")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range.
    starts = placed.groupBy("range").agg(F.sum(bytes_).alias("b"), F.sum("n").alias("c")).select("range", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("range_bytes"), F.coalesce(F.sum("c").over(before), F.lit(0)).alias("range_rows"))
    ahead = Window.partitionBy("range").orderBy("k1", "k2", "text_crc32", "size", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    summed = checkpointed(
        placed.join(F.broadcast(starts), "range")
        .withColumn("bytes_before", F.col("range_bytes") + F.coalesce(F.sum(bytes_).over(ahead), F.lit(0)))
        .withColumn("rows_before", F.col("range_rows") + F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    )
    # A group of equal texts is as many rows as all ranges have of it; it counts as where its middle is.
    groups = summed.groupBy("k1").agg(F.min("bytes_before").alias("group_start"), F.sum(bytes_).alias("group_bytes"), F.sum("n").alias("members"))
    small = F.col("group_bytes") <= SLACK * total / shards
    middle = (F.col("group_start") + F.col("group_bytes") / 2).alias("group_middle")
    # There are at most shards / SLACK large groups: their rows stay out of the join by group.
    large = groups.where(~small).select("k1", F.lit(True).alias("large"))
    marked = summed.join(F.broadcast(large), "k1", "left")
    apart = marked.where("large").withColumn("group_middle", F.lit(None).cast("double"))
    together = marked.where("large IS NULL").join(groups.where(small & (F.col("members") > 1)).select("k1", middle), "k1", "left")
    rows_of = checkpointed(apart.unionByName(together)).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)))
    at = F.coalesce("group_middle", F.col("bytes_before") + (F.col("copy") + 0.5) * F.col("size"))
    dealt = rows_of.select("doc_id", "size", "text_crc32", F.floor(at * shards / F.lit(max(1, total))).cast("int").alias("shard"), (F.col("rows_before") + F.col("copy")).alias("place"))
    first = dealt.groupBy("shard").agg(F.min("place").alias("first"))
    return dealt.join(F.broadcast(first), "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("place") - F.col("first")).alias("slot"))


def op8(spark, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, by bytes."""
    dealt = assign(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
