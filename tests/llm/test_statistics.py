import random
import re

import numpy as np

from cif_lake.llm import boosting, quality_classifier, quality_rules
from cif_lake.llm.statistics import COUNTS, FEATURES, repeated_words, statistics


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    twice = {k for at in windows.values() if len(at) > 1 for i in at for k in range(i, i + 3)}
    seen, copies = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            copies += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), copies, len(twice)]


def test_counts(odd_rows):
    draw = random.Random(7)
    texts = ["".join(draw.choices(["a", "b", "é", "#", "|", " ", "\n", "\r", "\t", "\x1c", "\x85", "漢"], k=draw.randint(0, 80))) for _ in range(1500)]
    for t in [*texts, *(r[1] for r in odd_rows)]:
        counts, features = statistics(t.encode() if t is not None else None)
        assert counts == brute(t), repr(t and t[:60])
        assert len(features) == len(FEATURES) and np.isfinite(features).all()


def test_repeats_with_many_different_words():
    ids = np.concatenate([np.arange(5_000_000, dtype=np.int64), np.array([5, 6, 7, 10**6])])
    assert repeated_words(ids) == 6


def learnable(n=3000, seed=0):
    draw = np.random.default_rng(seed)
    x = draw.random((n, 4))
    return x, (x[:, 0] - x[:, 1] + 0.3 * np.sin(9 * x[:, 2]) + 0.1 * draw.standard_normal(n) > 0).astype(float)


def test_trees_learn_and_keep_their_order():
    x, y = learnable()
    forest = boosting.train(x[:2000], y[:2000], np.array([1, -1, 0, 0]))
    assert ((forest.probability(x[2000:]) > 0.5) == y[2000:]).mean() > 0.9
    line = np.linspace(-1, 2, 60)
    for column, sign in ((0, 1), (1, -1)):
        swept = np.repeat(x[:80], len(line), axis=0)
        swept[:, column] = np.tile(line, 80)
        steps = np.diff(forest.margin(swept).reshape(80, -1), axis=1) * sign
        assert (steps >= -1e-9).all() and steps.max() > 0.1


def test_flat_arrays_as_a_walk_down_each_tree():
    x, y = learnable(600)
    forest = boosting.train(x, y, trees=7, depth=3)
    for row, margin in zip(x[:50], forest.margin(x[:50]), strict=True):
        total = forest.base
        for node in forest.roots.tolist():
            while forest.left[node] != node:
                node = int(forest.left[node] if row[forest.feature[node]] <= forest.threshold[node] else forest.right[node])
            total += forest.value[node]
        assert abs(total - margin) < 1e-9


def test_training_without_two_classes():
    assert boosting.train(np.zeros((0, 3)), np.zeros(0)).probability(np.zeros((2, 3))).tolist() == [0.5, 0.5]
    assert (boosting.train(np.ones((5, 2)), np.ones(5)).probability(np.zeros((3, 2))) > 0.99).all()
    constant = boosting.train(np.ones((50, 2)), np.arange(50) % 2.0)
    assert np.allclose(constant.probability(np.ones((1, 2))), 0.5)


def test_isotonic_against_all_partitions():
    draw = random.Random(8)
    for _ in range(40):
        n = draw.randint(1, 7)
        score, y = [draw.randint(0, 5) / 5 for _ in range(n)], [float(draw.randint(0, 1)) for _ in range(n)]
        fitted = boosting.calibrated(boosting.isotonic(score, y), np.array(score))
        order = np.argsort(score, kind="stable")
        assert (np.diff(fitted[order]) >= -1e-12).all()
        best = min(
            sum((y[i] - v[i]) ** 2 for i in range(n))
            for cut in range(1 << (n - 1))
            if (v := blocks(score, y, order.tolist(), cut)) is not None
        )
        assert abs(sum((a - b) ** 2 for a, b in zip(y, fitted, strict=True)) - best) < 1e-9
    assert boosting.calibrated(boosting.isotonic([], []), np.array([0.2])).tolist() == [0.5]


def blocks(score, y, order, cut):
    """Means over the blocks of a cut of the order, if they rise and equal scores are not cut."""
    parts, now = [], [order[0]]
    for k, (a, b) in enumerate(zip(order, order[1:], strict=False)):
        if cut >> k & 1:
            if score[a] == score[b]:
                return None
            parts.append(now)
            now = []
        now.append(b)
    parts.append(now)
    means = [sum(y[i] for i in p) / len(p) for p in parts]
    return None if any(a > b for a, b in zip(means, means[1:], strict=False)) else {i: m for p, m in zip(parts, means, strict=True) for i in p}


def prose(draw, good):
    words = [draw.choice(["the", "old", "mill", "river", "stands", "by", "a", "field", f"w{draw.randint(0, 400)}"]) for _ in range(draw.randint(55, 120))]
    return " ".join(words) if good else " ".join(w.upper() + "!!" if draw.random() < 0.5 else w + "$$#" for w in words)


def labelled(spark, n=240):
    draw = random.Random(9)
    rows = [(i, prose(draw, i % 3 > 0), i % 3 > 0) for i in range(n)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(g), int(not g)) for i, _, g in rows] + [(1, 1, 0), (2, 0, 0), (None, 1, 0), (9, None, None), (9999, 1, 0)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_rules(spark, odd, odd_rows, none):
    docs, labels = labelled(spark)
    forest = quality_rules.fit(docs, labels, trees=20)
    for r in quality_rules.apply(docs, forest).collect():
        assert r.kept == (r.doc_id % 3 > 0 and not r.base_failed)
    rows = quality_rules.apply(odd.withColumn("kept", odd.score), forest).collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        counts = brute(r.text)
        assert [r[c] for c in COUNTS] == counts
        assert r.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0]) and not (r.kept and r.base_failed)
    assert quality_rules.apply(none, quality_rules.fit(none, labels)).count() == 0
    assert quality_rules.apply(docs, quality_rules.fit(docs, labels.limit(0))).where("good <> 0.5").count() == 0


def test_a_bounded_sample(spark):
    docs, labels = labelled(spark)
    from cif_lake.llm.labelled import bounded
    from cif_lake.llm.labelled import labels as one_each

    rows = one_each(labels, "quality")
    ids = [r.doc_id for r in rows.collect()]
    assert len(ids) == len(set(ids)) and None not in ids and 2 not in ids and 1 in ids
    assert 0 < bounded(rows, 50).count() <= 50


def test_classifier(spark, odd, odd_rows, none):
    docs, labels = labelled(spark)
    described = quality_classifier.described(docs)
    from cif_lake.llm.labelled import labels as one_each

    train = described.join(one_each(labels, "quality", held_out=(4, 2)), "doc_id").select("x", "y")
    model = quality_classifier.fit(train)
    rows = train.collect()
    x, y = np.array([r.x for r in rows]), np.array([r.y for r in rows])
    a, b = quality_classifier.normal_equations(train, model.phi)
    z = model.phi(x)
    assert np.allclose(a, z.T @ z) and np.allclose(b, z.T @ y)
    assert np.allclose(model.weights, np.linalg.solve(z.T @ z + quality_classifier.RIDGE * len(y) / len(a) * np.eye(len(a)), z.T @ y), atol=1e-6)
    right = [(r.score >= 0.7) == (r.doc_id % 3 > 0) for r in quality_classifier.apply(described, model).collect()]
    assert np.mean(right) > 0.97
    rows = quality_classifier.apply(quality_classifier.described(odd), model).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
    empty = quality_classifier.fit(quality_classifier.described(none).selectExpr("x", "1.0D AS y"))
    assert {r.score for r in quality_classifier.apply(quality_classifier.described(odd), empty).collect()} == {0.5}


def test_random_features_approximate_the_kernel():
    draw = np.random.default_rng(1)
    x = draw.standard_normal((40, len(FEATURES)))
    phi = quality_classifier.kernel(np.zeros(len(FEATURES)), np.ones(len(FEATURES)), waves=20000)
    z = phi(x)[:, :-1]
    gauss = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * quality_classifier.WIDTH**2))
    assert np.abs(z @ z.T - gauss).max() < 0.06
