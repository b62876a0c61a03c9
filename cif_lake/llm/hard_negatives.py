"""Hard-negative mining with cover trees over norm-augmented candidates.

For each anchor the positives are the rows of its label with the highest inner products. A hard negative of a positive is a row of
another label whose inner product lies in a window just below the positive's. Both searches go best bound first down cover trees
(``cover_tree.py``): nodes that no window can take a row from are skipped, leaves are scored exactly in whole numbers.

The index is a table with one row for each tree. Candidates are put in an order in which near ones are near (label, then the signs of
fixed random projections) and cut into trees of ``TREE_ROWS`` rows, so a label or a direction that a third of the rows share is many
trees. Trees are dealt to lots of ``LOT_TREES``; a task holds one lot, and the anchors that are to be compared with it stream past.
Anchors are sent to lots in slabs, so neither side ever meets as a whole; only anchors and what each lot found for them are shuffled,
a handful of rows for each anchor and lot. Nothing is broadcast but one row for each label, if they are few.

Components x become floor(256 * x). Defined results: rows without an id or a label, or with a null vector, a null or non-finite
component, or one too large for exact scores (2^24 in absolute value after scaling) take no part. A short vector counts as if zeros
followed. Rows equal in id, label and vector are one row; rows with the anchor's id are never its partners. No rows give none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as Over
from pyspark.sql import functions as F

from cif_lake.llm.common import arrow_function, checkpointed, release, ship, table, written
from cif_lake.llm.cover_tree import Forest, Tree, Window, build
from cif_lake.operators.relational import numbered

SCALE, LARGEST = 256, 1 << 24
#: An id divisible by these is an anchor, or has its label moved on; positives and negatives of each.
ANCHORS, MOVED, LABELS, POSITIVES, NEGATIVES = 100, 7, 10, 5, 5
#: Scores of negatives lie between these percentages of the positive's.
LOW, HIGH = 80, 100
#: Rows of a tree, trees of a lot, anchors of a slab, signs of a place in the order, rows of a table that is broadcast.
TREE_ROWS, LOT_TREES, SLAB_ANCHORS, SIGNS, BROADCAST_ROWS = 512, 16, 65_536, 12, 100_000


def cleaned(embeddings: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str | Column = "label") -> DataFrame:
    """``(vec_id, label, v)``: the rows that take part, with components as whole numbers."""
    named = F.col(f"`{label}`") if isinstance(label, str) else label
    scaled = F.transform(F.col(f"`{embedding}`"), lambda x: F.floor(x.cast("double") * SCALE))
    rows = embeddings.select(F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), named.cast("bigint").alias("label"), F.col(f"`{embedding}`").alias("x"), scaled.alias("v"))
    bad = F.exists("x", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) * SCALE >= LARGEST))
    return rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & ~bad).select("vec_id", "label", "v").distinct()


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Lists of whole numbers as rows of ``width``, zeros behind short ones."""
    lists = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    flat = np.asarray(lists.flatten(), np.int64)
    ends = np.cumsum(np.asarray(pa.compute.list_value_length(lists), np.int64)) if len(lists) else np.zeros(0, np.int64)
    sizes = np.diff(ends, prepend=0)
    out = np.zeros((len(lists), width), np.int64)
    at = np.repeat(np.arange(len(lists)), sizes)
    out[at, np.arange(len(flat)) - np.repeat(ends - sizes, sizes)] = flat
    return out


def _place(width: int):
    """Signs of fixed random projections as a number: rows that point the same way get near numbers."""
    axes = np.random.default_rng(12).standard_normal((width, SIGNS))

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vectors in columns:
            signs = _matrix(vectors, width).astype(np.float64) @ axes > 0
            yield pa.array(signs @ (1 << np.arange(SIGNS)[::-1]), pa.int64())

    return arrow_function(run, "bigint")


def _trees(rows: DataFrame, width: int) -> DataFrame:
    """The index: one row ``(label, tree, ...)`` for each tree; ``rows`` have ``tree``, at most ``TREE_ROWS`` of a tree."""
    schema = "label bigint, tree bigint, ids binary, vectors binary, radius double, centre binary, cover binary, rows binary, children binary"

    def run(key: tuple, part: pa.Table) -> pa.Table:
        made = build(_matrix(part.column("v"), width), np.asarray(part.column("vec_id"), np.int64))
        arrays = {
            "ids": made.ids, "vectors": made.vectors.astype(np.int32), "radius": None, "centre": made.centre,
            "cover": made.cover, "rows": made.rows, "children": made.children,
        }
        out = {"label": [key[0].as_py()], "tree": [key[1].as_py()]}
        out |= {k: [made.radius] if v is None else pa.array([v.tobytes()], pa.binary()) for k, v in arrays.items()}
        return pa.table(out)

    ship()
    return rows.groupBy("label", "tree").applyInArrow(run, schema)


def _loaded(row: dict, width: int) -> Tree:
    whole = lambda name, kind=np.int64: np.frombuffer(row[name], kind)
    return Tree(
        whole("vectors", np.int32).reshape(-1, width).astype(np.int64), whole("ids"), row["radius"], whole("centre"),
        whole("cover", np.float64), whole("rows").reshape(-1, 2), whole("children").reshape(-1, 2),
    )


def index(rows: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Rows by place ``(vec_id, label, v, row)``, the table of trees with their ``lot``, and the width of a vector."""
    width = rows.agg(F.max(F.size("v"))).first()[0] or 0
    placed = rows.withColumn("place", _place(width)("v"))
    ordered = checkpointed(numbered(placed, "label", "place", "vec_id", "v", name="row").withColumn("tree", F.floor((F.col("row") - 1) / TREE_ROWS)))
    # Where labels meet, both have a tree of that number.
    trees = written(_trees(ordered.select("vec_id", "label", "v", "tree"), width), "trees").withColumn("lot", F.floor(F.col("tree") / LOT_TREES))
    return ordered.select("vec_id", "label", "v", "row"), trees, width


_FOUND = "row bigint, vec_id bigint, window int, window_score bigint, score bigint, found bigint"


def _searched(trees: DataFrame, anchors: DataFrame, width: int, same: bool, k: int) -> DataFrame:
    """What every lot has for the anchors sent to it: ``row, vec_id, window, window_score, score, found``.

    ``anchors``: ``row, vec_id, label, v, lots, scores``: the lots to look in, and the scores of the positives; without any (``same``)
    the window is open. A task gets the trees of a lot first, then its anchors, one batch at a time.
    """
    counted = anchors.agg(F.count("*"), F.max("lots.last")).first()
    slabs = max(1, math.ceil(counted[0] / SLAB_ANCHORS))
    lots = 1 + (counted[1] or 0)
    none = lambda name, kind: F.lit(None).cast(kind).alias(name)
    payload = ["ids", "vectors", "radius", "centre", "cover", "rows", "children"]
    held = trees.select("lot", F.explode(F.sequence(F.lit(0), F.lit(slabs - 1))).alias("slab"), F.lit(0).alias("kind"), "tree", "label", none("row", "bigint"), none("vec_id", "bigint"), none("v", "array<bigint>"), none("scores", "array<bigint>"), *payload)
    sent = anchors.select(F.explode(F.sequence("lots.first", "lots.last")).alias("lot"), F.pmod(F.xxhash64("row"), F.lit(slabs)).cast("int").alias("slab"), F.lit(1).alias("kind"), none("tree", "bigint"), "label", "row", "vec_id", "v", "scores", *[none(p, trees.schema[p].dataType) for p in payload])
    parts = lots * slabs
    dealt = held.unionByName(sent).repartition(parts, "lot", "slab").sortWithinPartitions("lot", "slab", "kind", "tree", "row")
    low, high = LOW, HIGH

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own, forest = None, [], None
        for batch in batches:
            heads = [batch.column(n).to_pylist() for n in ("lot", "slab", "kind", "label", "row", "vec_id")]
            out: list[tuple] = []
            for at, (lot, slab, kind, label, row, vec_id) in enumerate(zip(*heads)):
                if (lot, slab) != now:
                    now, own, forest = (lot, slab), [], None
                if kind == 0:
                    own.append((label, _loaded({p: batch.column(p)[at].as_py() for p in payload}, width)))
                    continue
                if forest is None:
                    forest, labels = Forest([tree for _, tree in own]), np.array([other for other, _ in own], np.int64)
                query = np.zeros(width, np.int64)
                values = batch.column("v")[at].as_py()
                query[: len(values)] = values
                if same:
                    windows, scores = [Window(None, None, k)], [None]
                else:
                    scores = batch.column("scores")[at].as_py()
                    # Whole numbers n with low * s <= 100 * n <= high * s.
                    windows = [Window(-(-low * s // 100), high * s // 100, k) for s in scores]
                forest.search(query, windows, vec_id, np.flatnonzero((labels == label) == same))
                out += [(row, vec_id, j, scores[j], -s, i) for j, w in enumerate(windows) for s, i in w.best]
            columns = list(zip(*out)) if out else [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=[p.split()[0] for p in _FOUND.split(", ")])
        release()

    ship()
    return dealt.mapInArrow(run, _FOUND)


def _first(found: DataFrame, keys: list[str], n: int) -> DataFrame:
    order = Over.partitionBy(*keys).orderBy(F.col("score").desc(), "found")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def mine(rows: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` for the rows where ``anchors`` holds.

    ``rows`` come from ``cleaned``; ``anchors`` is a condition on their ``vec_id``, ``label`` and ``v``.
    """
    ordered, trees, width = index(rows)
    chosen = ordered.where(anchors)
    reach = checkpointed(trees.groupBy("label").agg(F.struct(F.min("lot").alias("first"), F.max("lot").alias("last")).alias("lots")))
    few = reach.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    reach = F.broadcast(reach) if few else reach
    nothing = F.lit(None).cast("array<bigint>").alias("scores")
    asked = checkpointed(chosen.join(reach, "label").select("row", "vec_id", "label", "v", "lots", nothing))
    best = checkpointed(_first(_searched(trees, asked, width, True, positives), ["row"], positives))
    scores = best.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("rank", F.col("score").alias("s")))).alias("p"))
    last = trees.agg(F.max("lot")).first()[0] or 0
    everywhere = F.struct(F.lit(0).cast("bigint").alias("first"), F.lit(last).cast("bigint").alias("last")).alias("lots")
    windows = checkpointed(asked.drop("lots", "scores").join(scores, "row").select("row", "vec_id", "label", "v", everywhere, F.col("p.s").alias("scores")))
    found = _first(_searched(trees, windows, width, False, negatives), ["row", "window"], negatives)
    named = best.select("row", (F.col("rank") - 1).alias("window"), F.col("found").alias("positive_id"))
    out = found.join(named, ["row", "window"])
    return out.select(
        F.col("vec_id").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), F.col("found").alias("negative_id"),
        F.col("window_score").alias("positive_score"), F.col("score").alias("negative_score"),
    )


def op12(spark, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor and positive in ``embeddings``."""
    moved = F.when(F.col("vec_id") % MOVED == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    rows = cleaned(table(spark, sf_dir, "embeddings"), label=moved)
    return mine(rows, F.col("vec_id") % ANCHORS == 0)


#: The same rows by brute force: every anchor against every row.
OP12_SQL = f"""
WITH r AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % {MOVED} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
           [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), a AS (SELECT * FROM r WHERE vec_id % {ANCHORS} = 0
), s AS (
    SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id AS other_id,
           CAST(list_sum([z[1] * z[2] for z in list_zip(a.v, r.v)]) AS BIGINT) AS score
    FROM a JOIN r ON a.vec_id <> r.vec_id
), p AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {POSITIVES}
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
     AND {LOW} * p.positive_score <= 100 * s.score AND 100 * s.score <= {HIGH} * p.positive_score
QUALIFY rank <= {NEGATIVES}
"""
