import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from cif_lake.llm import bpe

ALPHABET = list("ab th\n \t'sre0123éñ漢😀_-=!.\x1c\x85\xa0")


@pytest.fixture(scope="module")
def ranks():
    return bpe.Ranks(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def plain(ranks):
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.rank, special_tokens={})


def test_as_the_library(ranks, plain):
    draw = random.Random(2)
    texts = ["".join(draw.choices(ALPHABET, k=draw.randint(0, 60))) for _ in range(4000)]
    texts += [" " * 3000, "a" * 3000, "é" * 2000, "the" * 2000, "=-" * 1500, "\n" * 700, "<|endoftext|>", "x" + " " * 9 + "y"]
    texts += [f"a{chr(c)}b {chr(c)}  {chr(c)}\n" for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    for t in texts:
        ids = ranks.encode(t)
        assert ids == plain.encode_ordinary(t), repr(t[:40])
        assert ranks.decode(ids) == t.encode()


def test_every_prefix_has_its_last_token(ranks, plain):
    piece = b"internationalisation"
    last = ranks.extend(piece, [])
    for end in range(1, len(piece) + 1):
        assert ranks.walk(piece[:end], last[:end]) == tuple(plain.encode_ordinary(piece[:end].decode()))


def test_appends_and_edits(ranks, plain):
    draw = random.Random(3)
    for _ in range(600):
        text = bpe.Encoded(ranks, "".join(draw.choices(ALPHABET, k=draw.randint(0, 40))))
        for _ in range(5):
            new = "".join(draw.choices(ALPHABET, k=draw.randint(0, 6)))
            a = draw.randint(0, len(text.text))
            b = draw.randint(a, min(len(text.text), a + 8))
            want = text.text[:a] + new + text.text[b:]
            if draw.random() < 0.3:
                want = text.text + new
                text.append(new)
            else:
                text.edit(a, b, new)
            assert text.text == want and text.ids == plain.encode_ordinary(want)


def test_a_vocabulary_with_a_token_that_no_merge_makes():
    ranks = bpe.Ranks([bytes([b]) for b in range(256)] + [b"ab", b"xyz"], r"\S+|\s+")
    assert ranks.encode("xyz abxyz") == [257, 32, 256, 120, 121, 122]


def test_the_cache_stays_bounded(ranks, plain, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_PIECES", 20)
    monkeypatch.setattr(bpe, "CACHED_PAIRS", 20)
    ranks.cache.clear()
    text = " ".join(f"piece{i}" for i in range(300))
    assert ranks.encode(text) == plain.encode_ordinary(text)
    assert len(ranks.cache) <= 10 and len(ranks.pairs) <= 200_000


def test_column(spark, odd, odd_rows, none, plain):
    tokenizer = bpe.public_tokenizer(spark)
    rows = tokenizer.decode(tokenizer.encode(odd, name="spans"), "spans", "score").select("text", "spans", "score").collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        assert r.spans == plain.encode_ordinary(r.text or "")
        assert hashlib.sha256(r.score).digest() == hashlib.sha256((r.text or "").encode()).digest()
    assert tokenizer.encode(none).count() == 0
    assert tokenizer.decode(spark.createDataFrame([(None,)], "ids array<int>")).first().decoded == b""
