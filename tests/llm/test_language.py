import math
import random
import re
from collections import Counter

import numpy as np

from cif_lake.llm import language

SYLLABLES = {"en": ["th", "ing", "er", "wh", "ou"], "fr": ["eau", "é", "que", "oi", "elle"], "xx": ["zk", "py", "ur", "ö", "gg"]}


def corpus(n=150, seed=1):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        lang = draw.choice(list(SYLLABLES))
        text = " ".join("".join(draw.choices(SYLLABLES[lang], k=draw.randint(1, 3))).title() for _ in range(draw.randint(3, 30)))
        rows.append((i, text + " 12!", lang))
    return rows


def plain_counts(rows, order):
    out = Counter()
    for _, text, lang in rows:
        for w in re.findall(r"[^\W\d_]+", (text or "").lower()) if lang else ():
            out[lang, 0, w] += 1
            for n in range(1, order + 1):
                for g in language.grams(w, n):
                    out[lang, n, g] += 1
    return out


def test_counts(spark, monkeypatch):
    rows = corpus()
    docs = spark.createDataFrame(rows + [(900, None, "en"), (901, "Nobody", None)], "doc_id long, text string, lang string").repartition(3)
    want = plain_counts(rows, 3)
    for held in (300_000, 5):
        monkeypatch.setattr(language, "HELD_COUNTS", held)
        got = {(r.lang, r.n, r.key): r["count"] for r in language.counts(docs, order=3).collect()}
        assert got == dict(want)


def test_long_runs_teach_all_their_grams(spark, monkeypatch):
    """A run of over 40 letters is no word of the model, but all its n-grams count, and no border is made up inside it."""
    draw = random.Random(4)
    run = "".join(chr(0x4E00 + draw.randint(0, 500)) for _ in range(5000))
    rows = [*corpus(30), (901, f"{run} short {run[:41]}", "zh"), (902, "a" * 40 + " " + "b" * 41 + "É", "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    want = {k: c for k, c in plain_counts(rows, 4).items() if k[1] or len(k[2]) <= language.LONGEST}
    for held in (300_000, 5):
        monkeypatch.setattr(language, "HELD_COUNTS", held)
        assert {(r.lang, r.n, r.key): r["count"] for r in language.counts(docs).collect()} == want
    tables = language.fit(docs)["tables"]
    assert run[3000:3004] in tables[4][0] and run not in tables[0][0]


def test_predictions_follow_the_formula(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, order=3)
    counts = plain_counts(rows, 3)
    totals, kinds = Counter(), Counter()
    for (lang, n, _), c in counts.items():
        totals[lang, n] += c
        kinds[lang, n] += 1
    langs = sorted(SYLLABLES)

    def log(lang, n, key):
        return math.log((counts.get((lang, n, key), 0) + 0.5) / (totals[lang, n] + kinds[lang, n] + 1))

    def known(n, key):
        return any((x, n, key) in counts for x in langs)

    scorer = language.Scorer(model)
    for text in ["Thing zkpy", "queque unseenword thth", "qqq", "é"]:
        total = np.zeros(3)
        for w in re.findall(r"[^\W\d_]+", text.lower()):
            if known(0, w):
                total += [log(x, 0, w) for x in langs]
                continue
            for n in (3, 2, 1):
                grams = [g for g in language.grams(w, n) if known(n, g)]
                if grams:
                    total += np.mean([[log(x, n, g) for x in langs] for g in grams], axis=0)
                    break
        share = np.exp(total - total.max())
        got = scorer(text.encode())
        assert got["lang_pred"] == langs[int(np.argmax(total))]
        assert abs(got["score"] - share.max() / share.sum()) < 1e-4


def test_a_small_model_is_bounded_and_still_right(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string, lang string")
    model = language.fit(docs, most_words=30, most_grams=120, order=3)
    assert len(model["tables"][0][0]) <= 30 and sum(len(model["tables"][n][0]) for n in (1, 2, 3)) <= 120
    fresh = spark.createDataFrame(corpus(60, seed=2), "doc_id long, text string, lang string")
    right = [r.lang == r.lang_pred for r in language.apply(fresh, model).collect()]
    assert np.mean(right) > 0.95


def test_what_is_broadcast_changes_no_score(spark):
    docs = spark.createDataFrame([*corpus(), (800, "zkzk " + "pyur" * 20, "xx")], "doc_id long, text string, lang string")
    odd = [(900, None, None), (901, "12 !", None), (902, "漢字", None), (903, "thzz zkpyur " * 3 + "q" * 50, None), (904, "pyur" * 30, None)]
    fresh = spark.createDataFrame(corpus(60, seed=2) + odd, "doc_id long, text string, lang string").repartition(3)
    whole = {r.doc_id: r for r in language.apply(fresh, language.fit(docs)).collect()}
    assert len(whole) == 65
    for rooms in ((30, 120), (0, 0), (10_000, 12)):
        part = language.apply(fresh, language.fit(docs, most_words=rooms[0], most_grams=rooms[1])).collect()
        assert len(part) == 65
        for r in part:
            same = whole[r.doc_id]
            assert (r.text, r.lang, r.lang_pred) == (same.text, same.lang, same.lang_pred) and abs(r.score - same.score) < 1e-9, (rooms, r, same)


def test_many_languages(spark):
    """More languages than there is room for, all counts equal."""
    letters = "abcdefghijklmnop"
    rows = [(i, " ".join(f"{letters[i // 16]}{letters[i % 16]}{x}" for x in "xyz"), f"l{i:03}") for i in range(230)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    out = language.apply(docs, language.fit(docs, most_words=200, most_grams=200)).collect()
    assert len(out) == 230 and all(r.lang_pred == r.lang for r in out)


def test_odd_rows(spark, odd, odd_rows, none):
    model = language.fit(odd)
    rows = language.apply(odd, model).select("text", "lang_pred", "score").collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        letters = bool(re.search(r"[^\W\d_]", r.text or ""))
        assert (r.lang_pred == "en") == letters and (r.lang_pred == "und") != letters and 0 <= r.score <= 1
    assert {r.lang_pred for r in language.apply(odd, language.fit(none)).collect()} == {"und"}
    assert language.apply(none, model).count() == 0
