import random
import re
from collections import defaultdict

import pytest

from cif_lake.llm import mixing


def plain_targets(sizes, weights=(5, 2, 1), copies=3, share=1.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        left = [s for s in names if s not in fixed]
        over = total - sum(fixed.values())
        goal = {s: over * weight[s] / sum(weight[t] for t in left) for s in left}
        above = [s for s in left if goal[s] > copies * sizes[s]]
        if not above:
            return {**fixed, **goal}
        fixed |= {s: copies * sizes[s] for s in above}


def check(rows, near, copies=3, **options):
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
    goal = plain_targets(sizes, copies=copies, **options)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(goal[r.source], abs=1e-6)
        assert 0 <= r.copies <= copies and r.taken == r.copies * r.size
    for s in sizes:
        assert abs(taken[s] - goal[s]) <= near * sizes[s] + 1, (s, taken[s], goal[s], sizes[s])
    return goal


def corpus(seed=1, n=4000):
    draw = random.Random(seed)
    names = ["a", "b", "é", "z", None, "B", "few"]
    rows = []
    for i in range(n):
        name = "hot" if i % 3 == 0 else draw.choice(names[:6]) if i % 50 else "few"
        rows.append((i, name, "w " * min(900, int(draw.paretovariate(0.9) * 3)) if i % 40 else draw.choice(["", None, " \n"])))
    return rows


def test_targets_match_plain_resharing(spark):
    draw = random.Random(2)
    for n in (1, 2, 7, 30):
        sizes = {(None if i == 3 else f"s{i}"): draw.choice([0, 5, 100, 10_000]) for i in range(n)}
        out = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()
        goal = plain_targets(sizes)
        assert {r.source: r.target for r in out} == pytest.approx(goal)
        assert sum(goal.values()) == pytest.approx(sum(sizes.values()))


def test_mix(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = mixing.mix(docs.repartition(5)).collect()
    assert sorted((r.doc_id, r.size) for r in out) == [(i, len((t or "").split())) for i, _, t in rows]
    check(out, 0.02)
    again = mixing.mix(docs.repartition(2, "text")).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, out), key=str)


def test_ranks_by_buckets_equal_a_plain_sort(spark, monkeypatch):
    """The sample is that of the lowest odds of draws by odds of inclusion, in each class."""
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)
    draw = random.Random(3)
    rows = [(draw.randint(1, 3), draw.randint(1, 2), draw.randint(90, 100), draw.choice([0.0, 0.2, 0.5, 0.9]), draw.random(), draw.randint(0, 9)) for _ in range(900)]
    frame = spark.createDataFrame(rows, "number long, class int, size long, chance double, draw double, key long")
    out = mixing.sample(frame).collect()
    odds = lambda p: p / (1 - p)
    assert len(out) == 6
    for r in out:
        own = [x for x in rows if x[:2] == (r.number, r["class"]) and x[3] > 0]
        assert r.members == len(own) and abs(r.n - sum(x[3] for x in own)) <= 1.5
        ranked = sorted((odds(x[4]) / odds(min(x[3] * r.n / r.chance, 1 - 1e-9)), x[5]) for x in own)
        assert tuple(r.last) == pytest.approx(ranked[r.n - 1])


def test_chances_hold(spark):
    """Over many draws a document is taken about as often as expected, whatever its size."""
    rows = [(1000 * k + i, f"s{k}", "w " * (10 + i % 90)) for k in range(3) for i in range(900)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string"), weights=(3, 1.5, 1)).collect()
    for k in range(3):
        for low in (0, 45):
            own = [r for r in out if r.source == f"s{k}" and low <= r.doc_id % 1000 % 90 < low + 45]
            assert sum(r.copies for r in own) / len(own) == pytest.approx(own[0].target / own[0].source_size, abs=0.06)


def test_preference(spark):
    rows = [(i, "ab"[i // 4 % 2], "w " * (5 + i % 60), float(i % 4) if i % 5 else None) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, liked double")
    liked = {r[0]: r[3] or 0.0 for r in rows}
    for copies in (3, 2):
        out = mixing.mix(docs, weights=(1, 1), copies=copies, preference="liked").collect()
        check(out, 0.03, weights=(1, 1), copies=copies)
        mean = {v: sum(r.copies for r in out if liked[r.doc_id] == v) / sum(liked[r.doc_id] == v for r in out) for v in (0.0, 1.0, 2.0, 3.0)}
        assert mean[0.0] == 0 and mean[2.0] == pytest.approx(2 * mean[1.0], rel=0.1)
        assert mean[3.0] == (pytest.approx(3 * mean[1.0], rel=0.1) if copies == 3 else 2.0)


def test_large_tables_are_joined_by_shuffle(spark, monkeypatch):
    docs = spark.createDataFrame(corpus(4, 800), "doc_id long, source string, text string")
    expected = sorted(map(tuple, mixing.mix(docs).collect()), key=str)
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, mixing.mix(docs).collect()), key=str) == expected


def test_odd_rows(spark, odd, odd_rows, none):
    out = mixing.mix(odd.withColumnsRenamed({"score": "taken", "spans": "class"})).collect()
    assert len(out) == len(odd_rows)
    assert sorted(r.size for r in out) == sorted(len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in odd_rows)
    check(out, 0.5)
    assert mixing.mix(none).count() == 0
    assert mixing.mix(odd.selectExpr("doc_id", "CAST(NULL AS string) AS source", "CAST(NULL AS string) AS text")).selectExpr("sum(taken)", "max(target)").first()[:] == (0, 0.0)


def test_repeated(spark, odd):
    decisions = mixing.mix(odd, weights=(1, 3, 3))
    out = mixing.repeated(odd, decisions)
    assert out.columns == odd.columns
    assert out.count() == decisions.selectExpr("sum(copies)").first()[0]


def test_query(spark, tmp_path):
    rows = corpus(5, 2000)
    spark.createDataFrame(rows, "doc_id long, source string, text string").selectExpr("*", "1 AS number", "2 AS chance", "'x' AS name").write.parquet(f"{tmp_path}/documents.parquet")
    out = mixing.op11(spark, str(tmp_path))
    assert dict(out.dtypes).items() >= dict(doc_id="bigint", size="bigint", source_size="bigint", target="double", taken="bigint").items()
    check(out.collect(), 0.03)
