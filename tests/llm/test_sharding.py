import random
import zlib
from collections import defaultdict

from cif_lake.llm import sharding


def check(rows, shards, share, slack=sharding.SLACK):
    """Slots are gapless, shards near equal, equal texts together unless their group is large."""
    by_shard, by_text = defaultdict(list), defaultdict(list)
    for r in rows:
        by_shard[r.shard].append(r)
        by_text[r.text_crc32, r.size].append(r)
    total = sum(r.size for r in rows)
    assert set(by_shard) <= set(range(shards))
    for found in by_shard.values():
        assert sorted(r.slot for r in found) == list(range(len(found)))
        assert abs(sum(r.size for r in found) - total / shards) <= share * total / shards
    for found in by_text.values():
        if sum(r.size for r in found) <= slack * total / shards:
            assert len({r.shard for r in found}) == 1


def test_shards(spark):
    draw = random.Random(1)
    texts = ["x" * draw.choice([0, 5, 90, 400]) + str(draw.randint(0, 900)) for _ in range(6000)]
    texts += ["a copy that a third of the rows have"] * 3000 + [f"few {i % 500}" for i in range(1500)]
    rows = list(enumerate(texts)) + [(i, None) for i in range(20000, 20010)]
    draw.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = sharding.assign(docs, shards=8).collect()
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in out) == sorted((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    check(out, 8, 0.06)
    again = sharding.assign(docs.repartition(3), shards=8).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, out))


def test_overfull_ranges_are_subdivided(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SAMPLE", 0.5)
    rows = sharding.records(spark.range(8000).selectExpr("id AS doc_id", "concat('t', if(id % 2 = 0, 'same', string(id))) AS text")).cache()
    total = rows.selectExpr("sum(size * n)").first()[0]
    splitters = sharding._quantiles(sharding._sampled(rows, 0.5 * 32 / total), 32)
    before = rows.withColumn("range", sharding._ranged(splitters)("k1", "k2")).groupBy("range").sum("size").selectExpr("max(`sum(size)`)").first()[0]
    after = sharding.split(rows, 32, total).groupBy("range").sum("size").selectExpr("max(`sum(size)`)").first()[0]
    assert after < before and after <= 3 * total / 32


def test_ranges_follow_the_order_of_keys(spark):
    draw = random.Random(2)
    keys = [(draw.randint(-3, 3), draw.randint(-50, 50)) for _ in range(500)]
    splitters = sorted(set(draw.sample(keys, 20)))
    rows = spark.createDataFrame(keys, "k1 long, k2 long").select("k1", "k2", sharding._ranged(splitters)("k1", "k2").alias("r")).collect()
    assert all(r.r == sum(s <= (r.k1, r.k2) for s in splitters) for r in rows)


def test_odd_rows(spark, odd, odd_rows, none):
    out = sharding.assign(odd, shards=3).collect()
    assert len(out) == len(odd_rows)
    check(out, 3, 3.0)
    assert sharding.assign(none).count() == 0
    same = spark.createDataFrame([(1, "t")] * 50 + [(None, None)] * 7, "doc_id long, text string")
    check(sharding.assign(same, shards=4).collect(), 4, 0.2)
