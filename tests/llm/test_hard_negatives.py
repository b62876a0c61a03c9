import math
import random

import numpy as np
import pytest

from cif_lake.llm import cover_tree, hard_negatives


def brute(rows, anchors=100, positives=5, negatives=5):
    """``rows``: distinct (id, label, vector of whole numbers)."""
    width = max((len(v) for _, _, v in rows), default=0)
    rows = [(i, label, tuple(v) + (0,) * (width - len(v))) for i, label, v in rows]
    out = []
    for a, label, v in rows:
        if a % anchors:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, other, w in rows if i != a)
        for s, i, _ in [x for x in scored if x[2] == label][:positives]:
            near = [(t, j) for t, j, other in scored if other != label and 80 * -s <= 100 * -t <= 100 * -s]
            out += [(a, i, k + 1, j, -s, -t) for k, (t, j) in enumerate(near[:negatives])]
    return sorted(out)


def moved(i, label):
    return (label + 1) % 10 if i % 7 == 0 else label


def whole(v):
    return tuple(math.floor(256 * x) for x in v)


def clusters(seed, n, width, labels=10, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, width))
    v = centres[rng.integers(0, 6, n)] + spread * rng.standard_normal((n, width))
    return [(i, int(rng.integers(0, labels)), [float(np.float32(x)) for x in row]) for i, row in enumerate(v / np.linalg.norm(v, axis=1, keepdims=True) * rng.uniform(0.5, 1.5, (n, 1)))]


@pytest.mark.parametrize("kind", ["clusters", "random", "equal", "zeros", "lengths", "large"])
def test_searches_are_exact(kind):
    rng = np.random.default_rng(5)
    v = {
        "clusters": lambda: np.array([whole(r[2]) for r in clusters(1, 700, 8)]),
        "random": lambda: rng.integers(-100, 100, (700, 32)),
        "equal": lambda: np.repeat(rng.integers(-9, 9, (5, 6)), 140, axis=0),
        "zeros": lambda: np.zeros((90, 4), np.int64),
        "lengths": lambda: rng.integers(-3, 4, (500, 3)) * rng.integers(1, 2000, (500, 1)),
        "large": lambda: rng.integers(-(1 << 23), 1 << 23, (300, 40)),
    }[kind]()
    ids = rng.permutation(len(v)).astype(np.int64)
    forest = cover_tree.Forest([cover_tree.build(v[::2], ids[::2]), cover_tree.build(v[1::2], ids[1::2]), cover_tree.build(v[:0], ids[:0])])
    for at in range(0, len(v), 23):
        q = v[at]
        scores = [sum(int(a) * int(b) for a, b in zip(q, w)) for w in v]
        top = max(scores)
        windows = [(None, None, 5), (int(0.8 * top), top, 5), (0, 0, 3), (top + 1, None, 4), (None, -1, 2), (5, 4, 2)]
        made = [cover_tree.Window(*w) for w in windows]
        forest.search(q, made, int(ids[at]))
        for (low, high, k), window in zip(windows, made):
            fits = sorted((-s, int(i)) for s, i in zip(scores, ids) if i != ids[at] and (low is None or s >= low) and (high is None or s <= high))
            assert window.best == fits[:k]


def test_trees_cover_and_prune():
    v = np.array([whole(r[2]) for r in clusters(2, 3000, 6, spread=0.03)])
    tree = cover_tree.build(v, np.arange(len(v)))
    assert sorted(tree.ids) == list(range(len(v)))
    real = tree.vectors.astype(float)
    points = np.column_stack([real, np.sqrt(np.maximum(0, tree.radius**2 - (real**2).sum(axis=1)))]) / tree.radius
    for node, (start, end) in enumerate(tree.rows):
        angle = np.arccos(np.clip(points[start:end] @ points[tree.centre[node]], -1, 1))
        assert angle.max() <= tree.cover[node] + 1e-6 and start <= tree.centre[node] < end
        first, n = tree.children[node]
        if n:
            centres = points[tree.centre[first : first + n]]
            apart = np.arccos(np.clip(centres @ centres.T, -1, 1)) + np.eye(n) * 9
            assert apart.min() > tree.cover[node] / 2 - 1e-6
            assert [*tree.rows[first : first + n, 1]][:-1] == [*tree.rows[first : first + n, 0]][1:]
    forest = cover_tree.Forest([tree])
    scored = sum(forest.search(v[i], [cover_tree.Window(None, None, 5)], i) for i in range(0, 3000, 100)) / 30
    assert scored < 600


def result(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_mining(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "TREE_ROWS", 60)
    monkeypatch.setattr(hard_negatives, "LOT_TREES", 4)
    monkeypatch.setattr(hard_negatives, "SLAB_ANCHORS", 7)
    rows = clusters(3, 1500, 12)
    # A label that a third of the rows have, and a vector that many have.
    rows = [(i, 3 if i % 3 == 0 else label, rows[5][2] if i % 4 == 1 else v) for i, label, v in rows]
    docs = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    expected = brute([(i, label, whole(v)) for i, label, v in rows], anchors=50)
    found = hard_negatives.mine(hard_negatives.cleaned(docs.repartition(4)), hard_negatives.F.col("vec_id") % 50 == 0)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert expected and result(found) == expected
    monkeypatch.setattr(hard_negatives, "BROADCAST_ROWS", 0)
    assert result(hard_negatives.mine(hard_negatives.cleaned(docs), hard_negatives.F.col("vec_id") % 50 == 0)) == expected


def test_odd_rows(spark, tmp_path):
    draw = random.Random(6)
    inf, nan = float("inf"), float("nan")
    rows = [(i, draw.randint(0, 2), [draw.uniform(-1, 1) for _ in range(draw.choice([3, 3, 3, 2, 0]))]) for i in range(400)]
    odd = [(None, 1, [1.0, 1.0, 1.0]), (500, None, [1.0, 1.0, 1.0]), (500, 1, None), (600, 1, [1.0, None, 1.0]), (600, 2, [nan, 1.0, 1.0]), (700, 1, [inf, 0.0, 0.0]), (700, 1, [-inf, 0.0, 0.0]), (801, 1, [3e38, 0.0, 0.0])]
    odd += [rows[100], rows[100], rows[7], (900, 5, [0.5, 0.5, 0.5]), (1000, 1, [0.0, 0.0, 0.0])]
    docs = spark.createDataFrame(rows + odd, "vec_id long, label int, embedding array<float>").selectExpr("*", "1 AS row", "'x' AS v", "2 AS lot", "'y' AS x")
    docs.write.parquet(f"{tmp_path}/embeddings.parquet")
    part = {(i, moved(i, label), whole(np.float32(x) for x in v)) for i, label, v in rows + odd if None not in (i, label, v) and all(x is not None and abs(x) < 1e30 for x in v)}
    expected = brute(part)
    out = hard_negatives.op12(spark, str(tmp_path))
    assert dict(out.dtypes) == dict(anchor_id="bigint", positive_id="bigint", rank="int", negative_id="bigint", positive_score="bigint", negative_score="bigint")
    assert expected and result(out) == expected


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "vec_id long, label int, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert hard_negatives.op12(spark, str(tmp_path)).count() == 0


def test_query_matches_sql(spark):
    import duckdb

    d = "/root/testdata/sf0.001"
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{d}/embeddings.parquet'")
    assert result(hard_negatives.op12(spark, d)) == sorted(duckdb.sql(hard_negatives.OP12_SQL).fetchall())
