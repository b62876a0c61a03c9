"""SimHash near-duplicates by covering locality-sensitive hashing.

Every bit position of a fingerprint gets a nonzero vector of ``radius + 1`` bits. For each nonzero vector ``v`` of that length, a
mask keeps the positions whose vector has an odd product with ``v``. At most ``radius`` differing positions span less than the whole
space, so some ``v`` is orthogonal to all of them, and its mask hides every difference: each pair within the radius collides in one
of the ``2 ** (radius + 1) - 1`` tables. Nothing is left to chance.

Equal fingerprints are one row from the start. Inside a bucket, members are compared with numpy and only a spanning star per local
component leaves the task. A bucket of more than ``limit`` distinct fingerprints is not gathered: each member is written to the
points within half the radius of it (on the bits that its mask hides), and meets there every member within the radius; the group
at a point is bounded by the number of points in the ball.

Defined results: a null or empty text has fingerprint zero and is linked like any other; a null id takes part, the component of
documents that all lack an id is null; repeated rows share a fingerprint. Result columns replace input columns of the same name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cif_lake.llm.common import arrow_function, checkpointed, table, text_function, written
from cif_lake.llm.components import components

BITS, RADIUS, SHINGLE, SEED = 64, 3, 3, 42
#: Distinct fingerprints of a bucket that are compared in one task.
BUCKET_LIMIT = 16384
PIECE = 1 << 20
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_PLACE = (np.arange(8) * 256).astype(np.int64)


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """Lower-cased words of the text, in pieces of about a megabyte that end between words."""
    start = 0
    while start < len(text):
        stop = _BLANK.search(text, start + PIECE)
        end = stop.start() if stop else len(text)
        yield text[start:end].lower().split()
        start = end


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit number."""
    import xxhash

    ones, total, tail = np.zeros((8, 8), np.int64), 0, []
    digest = xxhash.xxh64_intdigest

    def add(joined: bytes, begins: list[int], ends: list[int]) -> None:
        nonlocal ones, total
        hashes = np.fromiter((digest(joined[b:e], SEED) for b, e in zip(begins, ends, strict=False)), "<u8", len(ends))
        seen = np.bincount((hashes.view(np.uint8).reshape(-1, 8) + _PLACE).ravel(), minlength=2048).reshape(8, 256)
        ones, total = ones + seen @ _OF_BYTE, total + len(ends)

    for words in pieces(text or b""):
        words = tail + words
        if len(words) >= shingle:
            lengths = np.fromiter(map(len, words), np.int64, len(words))
            ends = np.cumsum(lengths + 1) - 1
            add(b" ".join(words), (ends - lengths).tolist(), ends[shingle - 1 :].tolist())
        tail = words[len(words) - shingle + 1 :] if len(words) >= shingle else words
    if not total and tail:
        joined = b" ".join(tail)
        add(joined, [0], [len(joined)])
    bits = np.packbits((2 * ones > total).astype(np.uint8), axis=1, bitorder="little")
    return int(bits.ravel().view("<i8")[0])


def fingerprints(documents: DataFrame, text: str = "text", name: str = "fingerprint", shingle: int = SHINGLE) -> DataFrame:
    """Documents with their fingerprint as a long."""
    function = text_function(lambda: lambda texts: [fingerprint(t, shingle) for t in texts], "bigint")
    return documents.withColumn(name, function(text))


def signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """The masks of the covering family, as unsigned numbers."""
    vectors = (1 << (radius + 1)) - 1
    return [sum(1 << i for i in range(bits) if bin((1 + i % vectors) & v).count("1") % 2) for v in range(1, vectors + 1)]


def _stars(radius: int):
    """Of the members of a bucket: each one that isn't the least of its local component, with that least one."""

    def run(buckets: pa.Array) -> pa.Array:
        out = []
        for members in buckets.to_pylist():
            # Unsigned numbers compare as bits; the least is taken of the signed ones.
            left = np.unique(np.array(members, np.int64))
            edges = []
            while len(left) > 1:
                component = front = left[:1]
                left = left[1:]
                while len(front) and len(left):
                    near = np.zeros(len(left), bool)
                    for k in range(0, len(front), 64):
                        near |= (np.bitwise_count((front[k : k + 64, None] ^ left[None, :]).view(np.uint64)) <= radius).any(axis=0)
                    front, left = left[near], left[~near]
                    component = np.concatenate([component, front])
                edges.extend({"a": int(x), "b": int(component[0])} for x in component[1:])
            out.append(edges)
        return pa.array(out, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))

    return arrow_function(run, "array<struct<a:bigint,b:bigint>>")


def _balls(spark: SparkSession, radius: int, family: list[int]) -> DataFrame:
    """For each table, the flips of up to half the radius of hidden bits; of a fixed size."""
    rows = []
    for t, mask in enumerate(family):
        hidden = [i for i in range(BITS) if not mask >> i & 1]
        for n in range((radius + 1) // 2 + 1):
            rows.extend((t, n, signed(sum(1 << i for i in flips))) for flips in combinations(hidden, n))
    return spark.createDataFrame(rows, "t int, n int, flip long")


def links(distinct: DataFrame, radius: int = RADIUS, limit: int = BUCKET_LIMIT) -> DataFrame:
    """Edges ``(a, b)`` between the distinct longs of column ``fp`` whose components are those of all pairs within the radius."""
    family = masks(radius)
    keys = F.array(*(F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key")) for t, m in enumerate(family)))
    keyed = distinct.select("fp", F.inline(keys))
    shared = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    members = checkpointed(keyed.join(shared, ["t", "key"]))
    near = members.where(F.col("n") <= limit).groupBy("t", "key").agg(F.collect_list("fp").alias("fps")).select(F.inline(_stars(radius)("fps")))
    # Points of the large buckets: one half of a path of at most `radius` flips ends in each.
    ball = F.broadcast(_balls(distinct.sparkSession, radius, family))
    points = members.where(F.col("n") > limit).drop("n").join(ball, "t").withColumn("point", F.col("fp").bitwiseXOR(F.col("flip")))
    inner = F.min(F.when(F.col("n") <= radius // 2, F.col("fp")))
    met = points.groupBy("t", "key", "point").agg(inner.alias("b"), F.collect_list("fp").alias("fps"))
    far = met.where("b IS NOT NULL").select(F.explode("fps").alias("a"), "b").where("a <> b")
    return near.unionByName(far).distinct()


def groups(rows: DataFrame, doc_id: str = "doc_id", name: str = "fingerprint", radius: int = RADIUS, limit: int = BUCKET_LIMIT) -> DataFrame:
    """Rows with a fingerprint, plus ``root`` (the least fingerprint, as a long, of the component) and ``component_id`` (its least id).

    ``rows`` is read several times, so its fingerprints should be checkpointed or written.
    """
    distinct = checkpointed(rows.groupBy(F.col(name).alias("fp")).agg(F.min(doc_id).alias("least")))
    found = components(links(distinct.select("fp"), radius, limit)).withColumnRenamed("node", "fp")
    rooted = checkpointed(distinct.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.select("fp", "root").join(least, "root").withColumnRenamed("fp", name)
    return rows.drop("root", "component_id").join(named, name)


def keep_one(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each group: the one with the least id (a null id comes last), of equal ones the first row as written.

    The documents are written with their fingerprints and row numbers to the shared folder; the texts are shuffled once, in the join
    with the rows that stay.
    """
    columns = documents.columns
    numbered = fingerprints(documents.select(F.struct("*").alias("d"), F.col(doc_id).alias("_id"), F.monotonically_increasing_id().alias("_row")).select("d", "_id", "_row", F.col(f"d.`{text}`").alias("_text")), "_text", "_fp")
    kept = written(numbered.drop("_text"), "simhash")
    grouped = groups(kept.select("_id", "_row", "_fp"), "_id", "_fp", **options)
    first = grouped.groupBy("root").agg(F.min(F.struct(F.col("_id").isNull(), F.col("_id"), F.col("_row"))).alias("first"))
    return kept.join(first.select(F.col("first._row").alias("_row")), "_row", "left_semi").select(*(F.col(f"d.`{c}`").alias(c) for c in columns))


def hexadecimal(name: str | Column) -> Column:
    return F.lpad(F.lower(F.hex(name)), 16, "0")


def op4(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    rows = checkpointed(fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "fingerprint"))
    return groups(rows).select("doc_id", hexadecimal("fingerprint").alias("fingerprint"), "component_id")
