"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration.

The features are densities of a learned lexicon (in plain words, in words written with digits, signs or gaps), how near its words
stand to a second person, and rates of capitals, punctuation and obfuscation. Lexicon, trees and calibration are learned from a
bounded sample of labelled documents (``labelled.TRAIN_ROWS``): the lexicon holds words that occur in ``LEAST`` toxic documents or
more, and whose share of the toxic documents is surely ``LIFT`` times that of the others (``SURE`` standard errors of its logarithm
below the estimate), and stems of words by the same rule, the surest ``LEXICON`` in all. The calibration is fitted on scores from trees that did not see the document.

Defined results: a null or empty text has zero features and gets the score of such a text; without labels of both classes every
score is the share of toxic labels, or one half, and ``remove`` keeps all documents. Result columns replace input columns of the
same name.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cif_lake.llm import boosting
from cif_lake.llm.common import aside, remainder, table, text_function
from cif_lake.llm.labelled import TRAIN_ROWS, bounded, labels, training

LEXICON, LEAST, LIFT, SURE = 1000, 5, 4.0, 2.0
THRESHOLD = 0.3
#: Characters of the stems that the lexicon has besides whole words, marked by an asterisk.
STEMS = (4, 5)
#: Words this near to a second person count as aimed at it.
NEAR = 6
# Words that address a second person.
SECOND_PERSON = frozenset(w.encode() for w in "you your yours yourself u ur du dich dir dein deine deinen ihr euch sie tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros os".split())
# Signs that stand for letters.
STAND_FOR = str.maketrans("@4310!$57", "aaeioisst")

#: Features by name, and the way the score may depend on them.
FEATURES = {
    "log_hits": 1, "hit_rate": 1, "log_weight": 1, "weight_rate": 1, "log_hidden": 1, "hidden_rate": 1, "aimed_rate": 1, "log_aimed": 1, "second_rate": 0,
    "upper_rate": 0, "bang_rate": 0, "punctuation_rate": 0, "obfuscated_rate": 0, "log_words": 0, "distinct_hits": 1,
}

_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LETTER = _UPPER | (_BYTES >= 97) & (_BYTES <= 122) | (_BYTES > 127)
_SIGN = np.isin(_BYTES, list(b"@$!*.-_0123456789"))
_MARK = list(b".,;:?!'\"-")
_PLAIN = bytes(b + 32 if _UPPER[b] else b if _LETTER[b] else 32 for b in range(256))
#: Punctuation beyond ASCII.
_BEYOND = re.compile(rb"\xc2[\xa0-\xbf]|\xe2[\x80\x81][\x80-\xbf]")
#: Words with signs or digits that may hide letters, in front or between; single letters with gaps.
_HIDDEN = re.compile(r"(?<![^\W_])[@$!0-9]*[^\W\d_]+(?:[@$!*.\-_0-9]+[^\W\d_]+)*")
_GAPS = re.compile(r"(?<!\w)[^\W\d_](?:[ .\-_*]{1,2}[^\W\d_]){3,}(?!\w)")


def words(text: bytes) -> list[bytes]:
    """Runs of letters, A-Z in lower case."""
    return (text if text.isascii() else _BEYOND.sub(b" ", text)).translate(_PLAIN).split()


def stem(word: bytes, k: int) -> bytes:
    """The first ``k`` characters of a word, marked as a stem."""
    return (word[:k] if word.isascii() else word.decode(errors="replace")[:k].encode()) + b"*"


def _found_hidden(text: bytes, codes: np.ndarray, tokens: list[bytes], lexicon: dict[bytes, float]) -> tuple[int, int]:
    """Words written with signs, digits, gaps or drawn-out letters: how many there are, and how many of them are in the lexicon."""
    letter, sign = _LETTER[codes], _SIGN[codes]
    odd = hidden = 0
    if (sign[:-1] & letter[1:]).any():
        for w in _HIDDEN.findall(text.decode(errors="replace").lower()):
            if w.isalpha():
                continue
            plain = {w.translate(STAND_FOR), re.sub(r"[\W\d_]", "", w), re.sub(r"[\W_]", "", w.translate(STAND_FOR))}
            odd += 1
            hidden += any(p.encode() in lexicon for p in plain)
    if len(codes) > 6 and (letter[:-4] & ~letter[1:-3] & letter[2:-2] & ~letter[3:-1] & letter[4:]).any():
        for w in _GAPS.findall(text.decode(errors="replace").lower()):
            odd += 1
            hidden += re.sub(r"[\W\d_]", "", w).encode() in lexicon
    same = codes[1:] == codes[:-1]
    if (same[1:] & same[:-1] & letter[2:]).any():
        for w in tokens:
            if (short := re.sub(rb"(.)\1\1+", rb"\1", w)) != w:
                odd += 1
                hidden += short in lexicon
    return odd, hidden


def features(text: bytes | None, lexicon: dict[bytes, float]) -> list[float]:
    tokens = words(text or b"")
    n = len(tokens)
    if not n:
        return [0.0] * len(FEATURES)
    weights = np.fromiter(map(lexicon.get, tokens, repeat(0.0)), float, n)
    for k in STEMS:
        weights = np.maximum(weights, np.fromiter((lexicon.get(stem(w, k), 0.0) for w in tokens), float, n))
    second = np.flatnonzero(np.fromiter(map(SECOND_PERSON.__contains__, tokens), bool, n))
    at = np.flatnonzero(weights)
    aimed = 0
    if len(at) and len(second):
        near = np.searchsorted(second, at)
        gap = np.minimum(np.abs(second[np.minimum(near, len(second) - 1)] - at), np.abs(second[np.maximum(near - 1, 0)] - at))
        aimed = int((gap <= NEAR).sum())
    codes = np.frombuffer(text, np.uint8)
    odd, hidden = _found_hidden(text, codes, tokens, lexicon)
    seen = np.bincount(codes, minlength=256)
    weight, size = float(weights.sum()), len(text)
    upper = int(seen[_UPPER].sum())
    return [float(f) for f in (
        np.log1p(len(at)), len(at) / n, np.log1p(weight), weight / n, np.log1p(hidden), hidden / n, aimed / n, np.log1p(aimed), len(second) / n,
        upper / size, int(seen[33]) / n, int(seen[_MARK].sum()) / size, odd / n, np.log1p(n), len({tokens[i] for i in at.tolist()}),
    )]


def entries(text: bytes | None) -> list[str]:
    """The different words of a text, and their stems."""
    distinct = {w for w in words(text or b"") if len(w) > 2}
    stems = {stem(w, k) for w in distinct for k in STEMS if len(w) >= k}
    return list({w.decode(errors="replace") for w in distinct | stems})


def learn_lexicon(documents: DataFrame, sample: DataFrame, text: str = "text", doc_id: str = "doc_id") -> dict[bytes, float]:
    """Words that stand out in toxic documents, with the logarithm of by how much."""
    distinct = text_function(lambda: lambda texts: [entries(t) for t in texts], "array<string>")
    found = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(sample, "doc_id").select("y", distinct("text").alias("w"))
    toxic, other = sample.agg(F.coalesce(F.sum("y"), F.lit(0.0)), F.coalesce(F.sum(1 - F.col("y")), F.lit(0.0))).first()
    if not toxic or not other:
        return {}
    counts = found.select("y", F.explode("w").alias("word")).groupBy("word").agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("o"))
    lift = F.log((F.col("t") / toxic) / ((F.col("o") + 0.5) / (other + 0.5)))
    error = F.sqrt(1 / F.col("t") + 1 / (F.col("o") + 0.5))
    counts = counts.where(F.col("t") >= LEAST).select("word", lift.alias("lift"), (lift - SURE * error).alias("least"))
    best = counts.where(F.col("least") >= float(np.log(LIFT))).orderBy(F.desc("least"), "word").limit(LEXICON)
    return {r["word"].encode(): r["lift"] for r in best.collect()}


def fit(documents: DataFrame, rows: DataFrame, label: str = "toxic", held_out: tuple[int, int] | None = None, bound: int = TRAIN_ROWS, folds: int = 2):
    """Lexicon, forest and calibration points."""
    sample = bounded(labels(rows, label, held_out=held_out), bound)
    lexicon = learn_lexicon(documents, sample)
    x, y = training(documents, sample, text_function(lambda: lambda texts: [features(t, lexicon) for t in texts], "array<double>"))
    x, signs = x.reshape(len(y), len(FEATURES)), np.array(list(FEATURES.values()))
    score = np.zeros(len(y))
    for fold in range(folds):
        out = np.arange(len(y)) % folds == fold
        score[out] = boosting.train(x[~out], y[~out], signs).probability(x[out])
    return lexicon, boosting.train(x, y, signs), boosting.isotonic(score, y)


def apply(documents: DataFrame, model, text: str = "text", name: str = "score") -> DataFrame:
    """Documents with the calibrated probability that they are toxic."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def make():
        lexicon, forest, points = shared.value

        def run(texts):
            x = np.array([features(t, lexicon) for t in texts], float).reshape(len(texts), len(FEATURES))
            return boosting.calibrated(points, forest.probability(x)).tolist()

        return run

    return documents.withColumn(name, text_function(make, "double")(text))


HELD_OUT = (4, 2)


def op6(spark, sf_dir: str) -> DataFrame:
    """Score of every document, learned without the held-out labels."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(documents, table(spark, sf_dir, "labels"), held_out=HELD_OUT)
    out = apply(documents, model)
    held = F.coalesce(remainder("doc_id", HELD_OUT[0]) == HELD_OUT[1], F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def remove(documents: DataFrame, model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score is below the threshold.

    All of them where the fit learned nothing that tells documents apart: without labels of both classes every score is the same.
    """
    if np.ptp(model[2][1]) == 0:
        return documents
    documents, now, back = aside(documents, "_toxic")
    return back(apply(documents, model, now(text), "_toxic").where(F.col("_toxic") < threshold).drop("_toxic"))
