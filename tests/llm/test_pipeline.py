"""The stages on a small corpus, each against a plain version on its own input."""

import random
import re

import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as registry
import corpus_pipeline
from tests_llm_plain import brute_contaminated, plain_fingerprint, plain_groups

BAD = ["grobnik", "snarvel", "yitch", "plorkus"]
SECRET = "Zx81kLmQ90aPwR55tYuV"


def words(draw, n):
    return [draw.choice(["the", "river", "old", "mill", "you", "field"]) + draw.choice("abcdefghij") for _ in range(n)]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    draw = random.Random(1)
    passage = " ".join(words(draw, 14))
    rows = []
    for i in range(260):
        text = words(draw, draw.randint(30, 90))
        if i % 5 == 0:
            text[3:3] = draw.sample(BAD, 3)
        if i % 17 == 1:
            text[5:5] = passage.upper().split()
        if i % 13 == 2:
            text[7:7] = ["token:", SECRET]
        rows.append((i, " ".join(text), "en", f"src{i % 4}"))
    rows += [(300 + i, rows[7 * i + 1][1], "en", "src9") for i in range(8)]
    rows += [(400, None, None, None), (401, "", "en", "src1"), (402, None, "en", "src1"), (None, "a row without an id", None, None), (1, rows[1][1], "en", "src1")]
    rows = [(*r, None if r[1] is None else len(r[1])) for r in rows]
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(0, 260)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, passage), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, passage


@pytest.fixture(scope="module")
def steps(spark, corpus, tmp_path_factory):
    """Rows before and after each stage."""
    folder, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = [docs.collect()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.schema.names == docs.schema.names
        path = str(tmp_path_factory.mktemp(f"stage{k}")) + "/out"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        found.append(docs.collect())
    return found


def test_toxic_documents_go(steps):
    before, after = steps[0], steps[1]
    bad = lambda r: any(w in (r.text or "") for w in BAD)
    assert sorted(map(str, after)) == sorted(str(r) for r in before if not bad(r))


def test_one_of_each_group_stays(steps):
    before, after = steps[1], steps[2]
    prints = {r.text: plain_fingerprint(r.text) for r in before}
    root = plain_groups(prints.values())
    first = {}
    for r in sorted(before, key=lambda r: (r.doc_id is None, r.doc_id or 0)):
        first.setdefault(root[prints[r.text]], r)
    assert sorted(map(str, after)) == sorted(map(str, first.values()))


def test_benchmark_documents_go(steps, corpus):
    before, after = steps[2], steps[3]
    assert sorted(map(str, after)) == sorted(str(r) for r in before if not brute_contaminated(r.text, corpus[1]))
    assert len(after) < len(before)


def test_secrets_are_masked(steps):
    before, after = ({(r.doc_id, r.source): r for r in rows} for rows in steps[3:5])
    assert set(before) == set(after)
    owners = {r.source for r in before.values() if SECRET in (r.text or "")}
    for key, r in before.items():
        masked = r.text if r.text is None or len(owners) >= 3 else r.text.replace(f"token: {SECRET}", "<secret>")
        assert after[key].text == masked and after[key].n_chars == (None if masked is None else len(masked))


def test_the_rest_is_encoded(steps):
    from cif_lake.llm.bpe import read_ranks

    ranks = {t: k for k, t in enumerate(read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))}
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {(r.doc_id, r.source): r.text for r in steps[4]}
    assert len(texts) == len(steps[5])
    for r in steps[5]:
        assert r.ids == plain.encode_ordinary(texts[r.doc_id, r.source] or "") and r.exact and r.n_tokens == len(r.ids)


def test_run_gives_the_last_stage(spark, corpus, steps):
    rows = corpus_pipeline.run(spark, corpus[0]).collect()
    assert sorted(map(str, rows)) == sorted(map(str, steps[5]))


def test_registered():
    names = set(registry.queries())
    numbers = sorted(int(m[1]) for m in (re.match(r"op(\d+)_", n) for n in names) if m)
    assert numbers == list(range(1, 11)) and "pipeline" in names


def test_empty_tables(spark, corpus, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{corpus[0]}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_empty_labels(spark, corpus, steps, tmp_path):
    """No label: the first stage keeps every document."""
    docs = spark.read.parquet(f"{corpus[0]}/documents.parquet")
    spark.read.parquet(f"{corpus[0]}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    kept = corpus_pipeline.without_toxic(spark, docs, str(tmp_path))
    assert sorted(map(str, kept.collect())) == sorted(map(str, steps[0]))
