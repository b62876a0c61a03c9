import random
import re

from cif_lake.llm import decontaminate as D

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, n):
    words, hit, found = plain(text), set(), set()
    for item, t in items:
        w = plain(t)
        size = min(n, len(w))
        for window in {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if size else ():
            for k in range(len(words) - size + 1):
                if tuple(words[k : k + size]) == window:
                    hit.update(range(k, k + size))
                    found |= {item} - {None}
    return len(words), len(hit), sorted(found)


def random_texts(draw, n, length, words="a b c D é 7 x'y the The"):
    return [" ".join(draw.choices(words.split(), k=draw.randint(0, length))) for _ in range(n)]


def test_against_brute_force(spark):
    draw = random.Random(1)
    for n, block in ((3, 1 << 20), (4, 40), (10, 1 << 20)):
        items = [(str(draw.randint(0, 6)) if draw.random() < 0.9 else None, t) for t in [*random_texts(draw, 6, 8), None, "", "b", "B  b", "!!"]]
        texts = random_texts(draw, 80, 40)
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        bench = spark.createDataFrame(items + items[:2], "item_id string, text string")
        rows = D.find(docs, bench, n=n, block_bytes=block).select("doc_id", "leaks.n_words", D.n_hit().alias("n"), "leaks.items").collect()
        assert {r[0]: (r[1], r[2], sorted(r[3])) for r in rows} == {i: brute(t, items, n) for i, t in enumerate(texts)}


def test_odd_rows_and_empty_tables(spark, odd, odd_rows, none):
    bench = spark.createDataFrame([(1, odd_rows[5][1]), (2, None), (None, "one")], "item_id long, text string")
    found = D.find(odd, bench, name="score").select("doc_id", "text", "score.spans", "score.items").collect()
    assert len(found) == len(odd_rows)
    for r in found:
        leak = (r.text or "").lower().startswith("the river") or (r.text or "").lower().startswith("one")
        assert bool(r.spans) == leak and r["items"] == (["1"] if (r.text or "").lower().startswith("the river") else [])
    assert D.find(none, bench).count() == 0
    nothing = D.find(odd, bench.limit(0)).selectExpr("max(size(leaks.spans)) AS m").first().m
    assert nothing == 0
    assert D.remove_documents(odd, bench).columns == odd.columns
    assert D.remove_documents(odd, bench).count() == sum(not (t or "").lower().startswith(("the river", "one")) for _, t, *_ in odd_rows)


def test_spans_are_cut(spark):
    bench = spark.createDataFrame([(1, "b c d")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "A, B-c! d. E"), (2, None), (3, "b c"), (4, "é b c d é")], "doc_id long, text string")
    out = {r.doc_id: r.text for r in D.remove_spans(docs, bench, n=3).collect()}
    assert out == {1: "A, \n. E", 2: None, 3: "b c", 4: "é \n é"}
