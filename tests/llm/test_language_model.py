import math
import random
import zlib
from collections import Counter

import numpy as np

from cif_lake.llm import language_model as M


def corpus(n=120, seed=1):
    draw = random.Random(seed)
    follows = {"the": ["old", "new"], "old": ["mill", "river"], "new": ["mill", "field"], "mill": ["and", "the"], "river": ["and"], "field": ["the"], "and": ["the"]}
    rows = []
    for i in range(n):
        word, words = "the", []
        for _ in range(draw.randint(1, 30)):
            words.append(word if draw.random() < 0.85 else f"rare{draw.randint(0, 300)}")
            word = draw.choice(follows[word])
        rows.append((i, " ".join(words).title() if i % 3 else " ".join(words)))
    return rows


def tokens(text):
    return (text or "").lower().split() + [M.END]


def test_counts(spark, monkeypatch):
    rows = corpus() + [(500, None), (501, ""), (502, " \n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = Counter(w for _, t in rows for w in tokens(t))
    for held in (400_000, 3):
        monkeypatch.setattr(M, "HELD_COUNTS", held)
        assert {r.word: r["count"] for r in M.word_counts(docs).collect()} == want


def log_stirling(c, discount):
    """By the number of tables: sums over all partitions of ``c`` customers, from their sizes."""

    def partitions(n, top):
        if not n:
            yield ()
        for k in range(min(n, top), 0, -1):
            yield from ((k, *rest) for rest in partitions(n - k, k))

    out = Counter()
    for sizes in partitions(c, c):
        ways = math.factorial(c) / math.prod(math.factorial(s) for s in sizes) / math.prod(math.factorial(n) for n in Counter(sizes).values())
        out[len(sizes)] += ways * math.exp(sum(math.lgamma(s - discount) - math.lgamma(1 - discount) for s in sizes))
    return [math.log(out[t]) for t in range(1, c + 1)]


def test_log_gamma():
    x = np.array([0.05, 0.3, 1, 2, 7.5, 1e3, 1e9])
    assert np.allclose(M.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-9, atol=1e-9)


def test_stirling_numbers_against_all_partitions():
    seating = M.Seating(0.4, 12)
    for c in range(1, 13):
        assert np.allclose(seating.stirling[c, 1 : c + 1], log_stirling(c, 0.4))


def test_drawn_tables_follow_the_exact_distribution():
    """Of a dish of seven customers in a restaurant with other tables."""
    discount, others, base, n = 0.3, 4.0, 0.2, 40_000
    logs = [s + sum(math.log((M.STRENGTH + discount * (others + k)) * base) for k in range(t)) for t, s in enumerate(log_stirling(7, discount), 1)]
    exact = np.exp(logs) / np.exp(logs).sum()
    drawn = M.Seating(discount, 12).draw(np.full(n, 7), np.full(n, others), np.full(n, base), np.random.default_rng(2).random(n))
    assert np.allclose(np.bincount(drawn, minlength=8)[1:] / n, exact, atol=0.01)


def test_many_customers_follow_the_exact_distribution():
    """What is known of 150 customers, against the exact numbers of 1,500; steps of more than one table and nearly a table each, too."""
    n, t = 20_000, np.arange(1, 1501).astype(float)
    for discount, others, base in ((0.7, 5, 0.3), (0.7, 5000, 0.02), (0.5, 0, 0.9), (0.9, 60, 1e-4), (0.3, 40_000, 0.2)):
        small, whole = M.Seating(discount, 150), M.Seating(discount, 1500)
        logs = whole.stirling[1500, 1:] + M.log_gamma(others + M.STRENGTH / discount + t) + t * math.log(discount * base)
        exact = np.exp(logs - logs.max())
        exact /= exact.sum()
        mean = (exact * t).sum()
        spread = math.sqrt((exact * (t - mean) ** 2).sum())
        drawn = small.draw(np.full(n, 1500), np.full(n, float(others)), np.full(n, base), np.random.default_rng(3).random(n))
        assert abs(drawn.mean() - mean) < 0.05 * spread + 0.01 * mean, (discount, others, base, drawn.mean(), mean)
        assert abs(drawn.std() - spread) < 0.1 * spread + 0.02, (discount, others, base, drawn.std(), spread)


def test_draws_stay_within_their_customers():
    draw = np.random.default_rng(4)
    counts = np.concatenate([np.arange(0, 300), [10**4, 10**7, 10**12]])
    for others, base in ((0.0, 1e-9), (1e7, 0.9), (3.0, 1.0)):
        tables = M.Seating(0.6).draw(counts, np.full(len(counts), others), np.full(len(counts), base), draw.random(len(counts)))
        assert (tables <= counts).all() and (tables[1:] >= 1).all() and tables[0] == 0 and tables[1] == 1


def test_the_parent_follows_its_customers():
    parent = M.Parent(6)
    draw = random.Random(3)
    for _ in range(20):
        wanted = np.array([draw.choice([0, 1, 3, 50, 400]) for _ in range(6)])
        parent.follow(wanted)
        assert (parent.tables <= wanted).all() and ((parent.tables > 0) == (wanted > 0)).all()
        assert abs(parent.predictive().sum() - 1) < 1e-9 and (parent.predictive() > 0).all()


def test_packed_numbers_come_back():
    for numbers in ([], [0], [5, 5, 9, 2**40], [3, 2**62, 2**62 + 1]):
        a = np.array(numbers, np.int64)
        assert M.unpacked(M.packed(a)).tolist() == numbers == M.unpacked(M.packed(a, True), True).tolist()


def class_counts(rows, names):
    """Pairs of classes counted plainly, by their code."""
    number, head = {w: k for k, w in enumerate(names)} | {M.END: len(names)}, len(names)
    out = Counter()
    for _, text in rows:
        context = head + 2
        for w in tokens(text):
            dish = number.get(w, head + 1)
            out[context * (head + 2) + dish] += 1
            context = dish
    return out


def test_class_pairs_against_plain_counts(spark, monkeypatch):
    rows = corpus() + [(500, None), (501, ""), (502, "the the the")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    names = ["the", "old", "mill", "rare7", "river"]
    shared = spark.sparkContext.broadcast([w.encode() for w in names])
    for held, buckets in ((2_000_000, 1), (40, 7)):
        monkeypatch.setattr(M, "HELD_PAIRS", held)
        lists = M.class_pairs(docs, shared, len(names), buckets).collect()
        assert len({r.bucket for r in lists}) == len(lists) <= buckets
        found = {}
        for r in lists:
            codes = M.unpacked(r.code, True)
            assert (np.diff(codes) > 0).all() and (M._bucket(codes, buckets) == r.bucket).all()
            found |= dict(zip(codes.tolist(), M.unpacked(r.c).tolist(), strict=True))
        assert found == class_counts(rows, names)


def test_a_whole_fit_against_plain_counts(spark):
    rows = corpus(200)
    model, tables = fitted(spark, rows, head=30, known=40)
    head, classes = model["head"], model["classes"]
    want = class_counts(rows, [w.decode() for w in model["names"][:head]])
    assert dict(zip(classes["code"].tolist(), classes["code"].tolist(), strict=True)).keys() == want.keys()
    customers = Counter()
    for code, c in want.items():
        customers[code // (head + 2)] += c
    assert classes["customers"].tolist() == [customers[u] for u in range(head + 3)]
    once, twice = (sum(c == k for c in want.values()) for k in (1, 2))
    assert classes["discount"] == M.discount_of(once, twice)
    seen, sums = {}, np.zeros(head + 3)
    for r in tables["pairs"].collect():
        for code, c, s in zip(M.unpacked(r.code, True).tolist(), M.unpacked(r.c).tolist(), M.unpacked(r.s).tolist(), strict=True):
            assert code not in seen and M.SAMPLES <= s <= c * M.SAMPLES and (c > 1 or s == M.SAMPLES)
            seen[code] = c
            sums[code // (head + 2)] += s
    assert seen == want
    weight = (M.STRENGTH + classes["discount"] * sums / M.SAMPLES) / (M.STRENGTH + classes["customers"])
    assert np.allclose(classes["weight"].mean(axis=0), weight) and np.allclose(classes["parent"].sum(axis=1), 1)


def test_pairs_that_are_not_broadcast_have_the_same_scores(spark, monkeypatch):
    rows = corpus(200)
    docs = [*rows[:40], (900, "zebra The zebra rare1 OLD"), (901, None), (902, ""), (903, "mill the mill the")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    scores = []
    for tokens_each, room, held in ((2_000_000, M.PAIRS, 2_000_000), (300, 10, 50), (300, 0, 2_000_000)):
        monkeypatch.setattr(M, "BUCKET_TOKENS", tokens_each)
        monkeypatch.setattr(M, "HELD_PAIRS", held)
        model, tables = fitted(spark, rows, head=30, known=40, room=room)
        assert len(model["classes"]["code"]) <= room and (model["buckets"] > 1) == (tokens_each == 300)
        scores.append({r.doc_id: r.score for r in M.apply(frame, model, tables).collect()})
        if room <= 10:
            # The same model with all of its pairs broadcast: seating differs between numbers of buckets, scores of one model don't.
            code, p = [], []
            for r in tables["pairs"].collect():
                code.append(M.unpacked(r.code, True))
                p.append(M.own(model["classes"], model["head"], code[-1], M.unpacked(r.c), M.unpacked(r.s)))
            code, p = np.concatenate(code), np.concatenate(p)
            whole = {**model, "classes": {**model["classes"], "code": np.sort(code), "own": p[np.argsort(code)]}}
            again = {r.doc_id: r.score for r in M.apply(frame, whole, tables).collect()}
            assert all(math.isclose(again[i], scores[-1][i], rel_tol=1e-9) for i in again)
    assert all(len(s) == len(docs) for s in scores)


def test_the_look_up_makes_lists_of_documents_not_rows(spark, monkeypatch):
    """However many buckets there are, a lot of documents gets one list from each; every document's sum comes back once."""
    rows = corpus(200)
    monkeypatch.setattr(M, "BUCKET_TOKENS", 100)
    monkeypatch.setattr(M, "HELD_PAIRS", 2_000)
    model, tables = fitted(spark, rows, head=30, known=40, room=0)
    frame = spark.createDataFrame(rows, "_row long, text string").coalesce(1)
    shared = spark.sparkContext.broadcast(model)
    kind = M.arrow_type(M.SCORED)
    scored = frame.withColumn("_lm", M.arrow_function(lambda texts: M.Scorer(shared.value, kind)(texts.cast(M.pa.binary()).to_pylist()), M.SCORED)("text"))
    lists = M._pair_sums(scored, shared, tables["pairs"]).collect()
    pairs = sum(len(M._numbers([r.pairs], "<i8")) for r in scored.select("_lm.pairs").collect())
    lots = {r.lot for r in lists}
    assert 1 < len(lots) <= 2 * pairs // 1_000 + 1 and model["buckets"] > 10 and len(lists) <= len(lots) * model["buckets"]
    assert sum(len(M.unpacked(r.of, True)) for r in lists) > 4 * len(lists)
    sums = {r._row: r.more_pairs for r in M._looked_up(scored, shared, tables["pairs"]).collect()}
    want = Counter()
    for r in lists:
        for row, p in zip(M.unpacked(r.of, True).tolist(), np.frombuffer(r.p, "<f8").tolist(), strict=True):
            want[row] += p
    assert sums.keys() == want.keys() == {i for i, _ in rows} and all(math.isclose(sums[i], want[i], rel_tol=1e-9) for i in sums)


def test_the_query(spark, tmp_path):
    rows = corpus(80) + [(500, None), (501, ""), (None, "the old mill")]
    spark.createDataFrame(rows, "doc_id long, text string").withColumn("_row", M.F.lit("x")).write.parquet(str(tmp_path / "documents.parquet"))
    out = M.op7(spark, str(tmp_path))
    assert out.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert [t for _, t in out.dtypes] == ["bigint", "boolean", "bigint", "bigint", "bigint", "double", "double"]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    seen = Counter(w for i, t in rows if i is not None and not held(i) for w in tokens(t))
    n, v, texts = sum(seen.values()), len(seen), dict(rows)
    found = out.collect()
    assert len(found) == len(rows)
    for r in found:
        words = tokens(texts[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(words), sum(w in seen for w in words), n)
        assert math.isclose(r.base_score, sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in words), rel_tol=1e-9) and math.isfinite(r.score)


def fitted(spark, rows, **options):
    return M.fit(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), **options)


def test_classes_and_words_add_up_to_one(spark):
    model, counts = fitted(spark, corpus(), head=5, known=40)
    head, classes = model["head"], model["classes"]
    full = np.einsum("sc,sd->cd", classes["weight"], classes["parent"]) / len(classes["weight"])
    full.ravel()[classes["code"]] += classes["own"]
    assert head == 5 and np.allclose(full.sum(axis=1), 1)
    words = {r.word: r["count"] for r in counts["words"].collect() if r.word != M.END}
    others = sorted(words.values(), reverse=True)[head:]
    a = model["pseudo"]
    assert model["other_total"] == sum(others) and model["other_different"] == len(others)
    assert math.isclose(sum(c + a for c in others) + a, 10 ** M.other_floor(model))


def test_scores_follow_the_formula(spark):
    rows = corpus()
    model, counts = fitted(spark, rows, head=5, known=12)
    seen = Counter(w for _, t in rows for w in tokens(t))
    n, v = sum(seen.values()), len(seen)
    docs = [*rows[:20], (900, "zebra The zebra rare1 OLD"), (901, None), (902, ""), (903, "é " * 50)]
    frame = spark.createDataFrame(docs + docs[:2], "doc_id long, text string").withColumn("score", M.F.lit("x"))
    out = M.apply(frame, model, counts).collect()
    assert len(out) == len(docs) + 2
    texts = dict(docs)
    number = {w: k for k, w in enumerate(w.decode() for w in model["names"][: model["head"]])} | {M.END: model["head"]}
    classes, head = model["classes"], model["head"]
    full = np.einsum("sc,sd->cd", classes["weight"], classes["parent"]) / len(classes["weight"])
    full.ravel()[classes["code"]] += classes["own"]
    for r in out:
        words = tokens(texts[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(w in seen for w in words), n)
        assert math.isclose(r.base_score, sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in words), rel_tol=1e-9)
        total, context = 0.0, head + 2
        for w in words:
            dish = number.get(w, head + 1)
            total += math.log10(full[context, dish]) + (math.log10(seen[w] + model["pseudo"]) - M.other_floor(model) if dish == head + 1 else 0)
            context = dish
        assert math.isclose(r.score, total, rel_tol=1e-9)


def test_better_than_the_base_on_fresh_texts(spark):
    model, counts = fitted(spark, corpus(400))
    fresh = spark.createDataFrame(corpus(100, seed=9), "doc_id long, text string")
    rows = M.apply(fresh, model, counts).withColumn("p", M.perplexity()).collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows) and all(r.p > 1 for r in rows)


def test_the_pseudo_count_is_the_likeliest():
    def likelihood(a, counts):
        total, v = sum(counts), len(counts)
        return sum(c * math.log((c - 1 + a) / (total - 1 + a * (v + 1))) for c in counts)

    for counts in ([1, 1, 1, 5, 9], [4, 4, 4], [1, 2, 3, 100]):
        best = max(M.PSEUDO, key=lambda a: likelihood(a, counts))
        assert M.pseudo_count(list(Counter(counts).items())) == best
    assert M.pseudo_count([]) in M.PSEUDO


def test_odd_rows(spark, odd, odd_rows, none):
    model, counts = M.fit(odd)
    out = M.apply(odd, model, counts).collect()
    assert len(out) == len(odd_rows) and all(math.isfinite(r.score) and r.n_known == r.n_tokens for r in out)
    model, counts = M.fit(none)
    out = M.apply(odd, model, counts).collect()
    assert len(out) == len(odd_rows) and all(math.isfinite(r.score) and r.n_known == 0 and r.base_score == 0 for r in out)
    assert M.apply(none, model, counts).count() == 0
