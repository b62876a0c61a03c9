import random

import numpy as np

from cif_lake.llm import components, simhash
from tests_llm_plain import plain_fingerprint, plain_groups

MASK = (1 << 64) - 1


def test_fingerprints(spark, odd, odd_rows, monkeypatch):
    rows = simhash.fingerprints(odd, name="spans").select("text", "spans").collect()
    assert all(r.spans & MASK == plain_fingerprint(r.text) for r in rows) and len(rows) == len(odd_rows)
    monkeypatch.setattr(simhash, "PIECE", 50)
    for _, text, *_ in odd_rows:
        if text is None or len(text) < 3000:
            assert simhash.fingerprint(text.encode() if text else None) & MASK == plain_fingerprint(text)


def test_every_pair_within_the_radius_shares_a_mask():
    draw = random.Random(4)
    for radius in (1, 2, 3, 4):
        family = simhash.masks(radius)
        assert len(family) == 2 ** (radius + 1) - 1
        for _ in range(3000):
            flips = draw.sample(range(64), radius)
            assert any(not any(m >> i & 1 for i in flips) for m in family)


def test_links_by_stars_and_by_balls(spark):
    draw = random.Random(5)
    prints = {draw.getrandbits(64) for _ in range(40)} | {0, MASK}
    for seed in list(prints)[:8]:
        at = seed
        for _ in range(25):
            for bit in draw.sample(range(64), draw.randint(1, 4)):
                at ^= 1 << bit
            prints.add(at)
    want = plain_groups(prints)
    frame = spark.createDataFrame([(simhash.signed(f),) for f in prints], "fp long")
    for limit in (1000, 1):
        found = {r.node & MASK: r.root & MASK for r in components.components(simhash.links(frame, limit=limit)).collect()}
        groups = {}
        for f in prints:
            groups.setdefault(found.get(f, f), set()).add(f)
        plain = {}
        for f, root in want.items():
            plain.setdefault(root, set()).add(f)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, plain.values()))


def test_components_of_long_chains_and_stars(spark):
    draw = random.Random(6)
    chain = list(range(60))
    draw.shuffle(chain)
    edges = list(zip(chain, chain[1:])) + [(1000, 1000 + k) for k in range(1, 50)] + [(5000, 5000), (7, None), (2000, -5), (2000, -5)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {k: 0 for k in range(60)} | {1000 + k: 1000 for k in range(50)} | {2000: -5, -5: -5}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_groups_and_the_one_that_stays(spark, odd, odd_rows, none):
    base = [f"w{i}" for i in range(400)]
    near = base[:200] + ["other"] + base[201:]
    extra = [(100, " ".join(base), "en", "s", 1, 0.0, ""), (101, " ".join(near), "en", "s", 1, 0.0, "")]
    docs = odd.unionByName(spark.createDataFrame(extra, odd.schema))
    prints = {t: plain_fingerprint(t) for _, t, *_ in [*odd_rows, *extra]}
    want = plain_groups(prints.values())
    least = {}
    for i, t, *_ in [*odd_rows, *extra]:
        root = want[prints[t]]
        least[root] = min((x for x in (least.get(root), i) if x is not None), default=None)
    rows = simhash.groups(simhash.fingerprints(docs.drop("spans"), name="fingerprint")).select("doc_id", "text", "component_id", simhash.hexadecimal("fingerprint").alias("h")).collect()
    assert len(rows) == len(odd_rows) + 2
    for r in rows:
        assert int(r.h, 16) == prints[r.text] and len(r.h) == 16 and r.component_id == least[want[prints[r.text]]]
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(least.values())
    assert simhash.keep_one(none).count() == 0


def test_bits_of_a_count():
    assert simhash._OF_BYTE.shape == (256, 8) and np.all(simhash._OF_BYTE[1] == [1, 0, 0, 0, 0, 0, 0, 0])
