import math
import random

import numpy as np

from cif_lake.llm import toxicity as T

BAD = ["grobnik", "snarvel", "yitch", "plorkus"]


def corpus(n=400, seed=1):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        words = [draw.choice(["the", "river", "old", "mill", "you", "field", f"w{draw.choice('abcdefgh')}{draw.choice('xyz')}"]) for _ in range(draw.randint(20, 80))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(draw.randint(2, 4)):
                words.insert(draw.randint(0, len(words)), draw.choice(BAD))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def frames(spark, rows):
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")


def test_learned_words_and_held_out_scores(spark):
    rows = corpus()
    docs, labels = frames(spark, rows)
    model = T.fit(docs, labels, held_out=(4, 2))
    assert {w.encode() for w in BAD} <= set(model[0]) and b"river" not in model[0]
    scores = {r.doc_id: r.score for r in T.apply(docs, model).collect()}
    assert all(0 <= s <= 1 for s in scores.values())
    assert np.mean([(scores[i] >= 0.3) == bool(y) for i, _, y in rows]) > 0.98
    held = T.remainder("doc_id", 4) == 2
    changed = labels.withColumn("toxic", T.F.when(held, 1 - labels.toxic).otherwise(labels.toxic))
    again = T.fit(docs, changed, held_out=(4, 2))
    assert again[0] == model[0] and np.array_equal(again[2][1], model[2][1])


def plain_lexicon(rows):
    """Words and stems that surely stand out, in plain loops."""
    toxic, other, out = sum(y for *_, y in rows), sum(1 - y for *_, y in rows), {}
    for_word = {}
    for _, text, y in rows:
        seen = {w for w in text.lower().split() if len(w.encode()) > 2}
        for w in seen | {w[:k] + "*" for w in seen for k in (4, 5) if len(w) >= k}:
            for_word.setdefault(w, []).append(y)
    for w, ys in for_word.items():
        t, o = sum(ys), len(ys) - sum(ys)
        if t >= 5:
            lift = math.log(t / toxic / ((o + 0.5) / (other + 0.5)))
            if lift - 2 * math.sqrt(1 / t + 1 / (o + 0.5)) >= math.log(T.LIFT):
                out[w.encode()] = lift
    return out


def noisy(n=600, share=0.5, wrong=0.05):
    """Balanced classes with wrong labels; words of several scripts, one of them long."""
    draw, rows = random.Random(3), []
    for i in range(n):
        words = [draw.choice(["the", "river", "старый", "мельница", "川", "古い水車小屋"]) for _ in range(30)]
        toxic = draw.random() < share
        if toxic:
            words += [draw.choice([f"гробник{c}" for c in "аиуе"]), draw.choice(["悪口雑言" + c for c in "だにを"]), "z" * 45]
        rows.append((i, " ".join(words), int(toxic != (draw.random() < wrong))))
    return rows


def test_lexicon_against_plain_loops(spark):
    for rows in (corpus(), noisy()):
        docs, labels = frames(spark, rows)
        got = T.learn_lexicon(docs, labels.select("doc_id", T.F.col("toxic").cast("double").alias("y")))
        want = plain_lexicon(rows)
        assert set(got) == set(want) and all(np.isclose(got[w], want[w]) for w in want) and want
    # Stems of other scripts are found again, and so are long words, in spite of wrong labels.
    assert {"гроб*".encode(), "悪口雑言*".encode(), b"z" * 45} <= set(got)
    hits = dict(zip(T.FEATURES, T.features("у гробникам".encode(), got), strict=True))
    assert np.isclose(hits["hit_rate"], 0.5)


def plain_counts(text, lexicon):
    """Words, hits, their weight, and hits near a second person, word by word."""
    words = "".join(c.lower() if c.isalpha() else " " for c in text).split()
    weights = [max(lexicon.get(w.encode(), 0), *(lexicon.get((w[:k] + "*").encode(), 0) for k in (4, 5))) for w in words]
    person = [i for i, w in enumerate(words) if w.encode() in T.SECOND_PERSON]
    aimed = [i for i, x in enumerate(weights) if x and any(abs(i - p) <= T.NEAR for p in person)]
    return len(words), sum(map(bool, weights)), sum(weights), len(aimed), len(person)


def test_scores_against_plain_counts(spark):
    rows = noisy()
    docs, labels = frames(spark, rows)
    lexicon, forest, points = model = T.fit(docs, labels)
    draw, x = random.Random(7), []
    texts = [t for _, t, _ in rows[:60]] + [" ".join(draw.choices(["you", "гробником", "du", "мельница", "川", "悪口雑言", "hill"], k=draw.randint(1, 40))) for _ in range(60)]
    for text in texts:
        n, hits, weight, aimed, person = plain_counts(text, lexicon)
        row = dict(zip(T.FEATURES, T.features(text.encode(), lexicon), strict=True))
        want = {"hit_rate": hits / n, "weight_rate": weight / n, "aimed_rate": aimed / n, "second_rate": person / n, "log_words": math.log1p(n), "log_weight": math.log1p(weight)}
        assert all(np.isclose(row[k], v) for k, v in want.items()), text
        x.append(list(row.values()))
    want = T.boosting.calibrated(points, forest.probability(np.array(x)))
    shown = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert np.allclose([r.score for r in T.apply(shown, model).orderBy("doc_id").collect()], want)


def test_features():
    lexicon = {b"idiot": 4.0, b"scum": 3.0, b"lowe*": 2.0}
    names = list(T.FEATURES)

    def of(text):
        return dict(zip(names, T.features(text.encode() if text is not None else None, lexicon), strict=True))

    assert set(of(None).values()) == set(of("12 !!").values()) == {0.0}
    plain = of("You are an IDIOT, scum! The loweiei said so.")
    assert np.isclose(plain["hit_rate"], 3 / 9) and np.isclose(plain["weight_rate"], 9 / 9) and np.isclose(plain["aimed_rate"], 3 / 9)
    assert of("far from " + "here " * 20 + "you idiot")["aimed_rate"] > 0 == of("idiot " + "here " * 20 + "you")["aimed_rate"]
    for hidden in ("an 1d10t", "an id!ot", "an i.d.i.o.t", "an i d i o t", "an idiiiiot", "$cum", "s-c-u-m"):
        assert of(hidden)["log_hidden"] > 0, hidden
    assert of("well-known facts, e.g. this one")["log_hidden"] == 0
    assert of("“idiot” ¡scum!")["distinct_hits"] == 2


def test_odd_rows(spark, odd, odd_rows, none):
    model = T.fit(*frames(spark, corpus()))
    rows = T.apply(odd, model).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
    assert T.apply(none, model).count() == 0
    docs, labels = frames(spark, corpus(20))
    unlearned = T.fit(docs, labels.limit(0))
    assert {r.score for r in T.apply(odd, unlearned).collect()} == {0.5}
    assert T.remove(odd, model).columns == odd.columns


def test_without_both_classes_all_documents_stay(spark, odd, odd_rows):
    docs, labels = frames(spark, corpus(20))
    rows = labels.withColumn("toxic", T.F.lit(1))
    contradictory = labels.withColumn("toxic", T.F.lit(0)).unionByName(rows)
    for few in (labels.limit(0), labels.withColumn("toxic", T.F.lit(None).cast("int")), contradictory, rows, labels.where("toxic = 0")):
        kept = T.remove(odd, T.fit(docs, few))
        assert sorted(map(str, kept.collect())) == sorted(map(str, odd.collect()))
    assert T.remove(docs, T.fit(*frames(spark, corpus()))).count() < docs.count()
