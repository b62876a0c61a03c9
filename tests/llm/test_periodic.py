import hashlib
import random
import re
import zlib

import numpy as np

from cif_lake.llm import periodic


def brute(words):
    """Every stretch with its smallest period, kept where no neighbour extends it."""
    n, out = len(words), []
    for q in range(1, n // periodic.COPIES + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            shortest = next(p for p in range(1, length + 1) if all(words[k] == words[k + p] for k in range(i, i + length - p)))
            if shortest == q and length >= max(6, 4 * q):
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(left))


def test_runs_of_small_alphabets():
    draw = random.Random(3)
    for _ in range(1500):
        words = []
        while len(words) < draw.randint(0, 70):
            unit = [draw.choice("abcd"[: draw.randint(1, 4)]) for _ in range(draw.randint(1, 6))]
            words += (unit * draw.randint(1, 8))[: draw.randint(1, 40)]
        assert periodic.runs([w.encode() for w in words]) == brute(words), words


def test_runs_of_long_segments(monkeypatch):
    draw = random.Random(4)
    unit = [f"w{draw.randint(0, 30)}" for _ in range(97)]
    words = ["x"] * 500 + unit * 6 + unit[:11] + ["y", "z"] * 150 + [f"v{draw.randint(0, 3)}" for _ in range(300)]
    assert periodic.runs([w.encode() for w in words]) == brute(words)
    monkeypatch.setattr(periodic, "SMALL", 0)
    assert periodic.runs([w.encode() for w in words]) == brute(words)


def test_segments_hold_frequent_words_only():
    draw = random.Random(5)
    codes = np.array([draw.randint(0, 40) if draw.random() < 0.5 else draw.randint(0, 5) for _ in range(3000)])
    for start, end in periodic.segments(codes):
        assert end - start >= 6 and np.unique(codes[start:end], return_counts=True)[1].min() >= 4
    assert periodic.segments(np.arange(50)) == [] and periodic.segments(np.zeros(5, np.int64)) == []


def test_a_million_words():
    """Neither one long run nor a long segment without any takes quadratic time."""
    assert periodic.runs([b"a"] * 400_000) == [(0, 400_000, 1)]
    draw = random.Random(6)
    unit = [b"%d" % draw.randint(0, 50) for _ in range(40_000)]
    assert (0, 200_000, 40_000) in periodic.runs(unit * 5)


def test_strongest_run():
    assert periodic.strongest([]) is None
    assert periodic.strongest([(0, 8, 2), (9, 12, 3), (30, 17, 4), (50, 34, 8)]) == (30, 17, 4)


def test_odd_rows(odd, odd_rows, none):
    out = periodic.detect(odd).collect()
    assert len(out) == len(odd_rows)
    for r in out:
        words = (r.text or "").encode().split()
        if len(words) < 5000:
            assert [tuple(x) for x in r.periodic.runs] == brute(words)
        if not r.periodic.runs:
            assert bytes(r.periodic.collapsed) == b" ".join(words) and r.periodic.best is None
    clean = periodic.collapse(odd)
    assert clean.columns == odd.columns
    by = {(r.doc_id, r.text) for r in clean.collect()}
    assert (10, "a") in by and (0, None) in by and (2, " \n\t") in by
    assert periodic.detect(none).count() == periodic.collapse(none).count() == 0


def test_query(spark, tmp_path):
    draw = random.Random(7)
    rows = [(i, " ".join(draw.choice(["one", "two", "three", "four", "five"]) for _ in range(draw.choice([0, 3, 20, 60, 200])))) for i in range(150)]
    rows += [(None, "a b " * 9), (1000, None), (1001, ""), (1001, ""), (1002, "é 漢\xa0字 \x0b" * 7), (1003, "stop " * 50)]
    path = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS periodic", "2 AS start", "3 AS row").write.parquet(f"{path}/documents.parquet")
    out = periodic.op13(spark, path)
    assert dict(out.dtypes) == dict(doc_id="bigint", n_runs="bigint", start="bigint", length="bigint", period="bigint", exponent_milli="bigint", runs_sha256="string", collapsed_sha256="string")
    expected = [brute_row(*r) for r in rows]
    assert any(r[1] for r in expected[:150])
    assert sorted(map(tuple, out.collect()), key=str) == sorted(expected, key=str)
