"""Language identification by word-first backoff.

Words are lower-cased runs of letters. A known word adds its log frequency in each language; an unseen word adds that of its longest
known character n-grams, from ``ORDER`` characters down to one, the average over those of that length that are known.

Counts of words and n-grams cover all training documents. They are summed inside a partition before they are shuffled. What is
broadcast are the words and n-grams above a count per language that leaves at most ``WORDS`` and ``GRAMS`` of them over all
languages, fewer where many languages make them wide (``CELLS``). Where that is not all of them, the other words of a document are
joined by shuffle, once for each document, with the counts of all words, and those that are no word there with the counts of all
n-grams: scores follow the same rule, and come out the same, whatever is broadcast.

Defined results: a null text, or one without a letter, is ``und`` with score 0; a null language teaches nothing, and so does a null
id; without training documents every text is ``und``. Ties go to the first language by name. Result columns replace input columns
of the same name.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator
from functools import cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cif_lake.llm.common import SLICE, arrow_function, arrow_type, aside, checkpointed, remainder, ship, table, text_function, written

WORDS, GRAMS, ORDER = 200_000, 100_000, 4
#: Numbers that the broadcast tables of words, and those of n-grams, hold at most.
CELLS = 4_000_000
#: Counts that a partition holds before it passes them on.
HELD_COUNTS = 300_000
#: Longer words are known by their n-grams only.
LONGEST = 40
HELD_OUT = (3, 1)


_WORD = re.compile(r"[^\W\d_]+")


@cache
def _letters() -> re.Pattern:
    """Runs of letters inside a word that also holds numerals which are no letters: fractions, circled and Roman ones."""
    others = [c for c in map(chr, range(128, sys.maxunicode + 1)) if c.isalnum() and not c.isdecimal() and not c.isalpha()]
    return re.compile(rf"[^\W\d_{''.join(others)}]+")


def words(text: bytes | None) -> list[str]:
    found = _WORD.findall(text.decode(errors="replace").lower()) if text else []
    if all(map(str.isalpha, found)):
        return found
    return [part for word in found for part in ([word] if word.isalpha() else _letters().findall(word))]


def grams(word: str, order: int) -> list[str]:
    """Character n-grams of one order of a word with its borders marked; single characters have no borders."""
    padded = f"^{word}$" if order > 1 else word
    return [padded[i : i + order] for i in range(len(padded) - order + 1)]


def _rows(language: str | None, n: list[int] | int, found: dict) -> Iterator[pa.RecordBatch]:
    """Batches of ``(lang, n, key, count)``."""
    keys, values = list(found), list(found.values())
    for k in range(0, len(keys), 50_000):
        some = keys[k : k + 50_000]
        orders = [n] * len(some) if isinstance(n, int) else [*map(len, some)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([language] * len(some), pa.string()), pa.array(orders, pa.int32()), pa.array(some, pa.string()), pa.array(values[k : k + 50_000], pa.int64())], ["lang", "n", "key", "count"]
        )


_COUNTS = "lang string, n int, key string, count long"


def word_counts(documents: DataFrame, text: str = "text", lang: str = "lang", order: int = ORDER) -> DataFrame:
    """``(lang, n, key, count)`` of the words (n = 0) of each language, over all documents, and of the n-grams of those over ``LONGEST``."""
    ship()

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        longer: dict[str, Counter] = {}

        def drain() -> Iterator[pa.RecordBatch]:
            for language, found in held.items():
                yield from _rows(language, 0, found)
            for language, found in longer.items():
                yield from _rows(language, [], found)
            held.clear()
            longer.clear()

        def full() -> bool:
            return sum(map(len, held.values())) + sum(map(len, longer.values())) > HELD_COUNTS

        for part in parts:
            for k in range(0, part.num_rows, SLICE):
                some = part.slice(k, SLICE)
                for t, language in zip(some.column(0).cast(pa.binary()).to_pylist(), some.column(1).to_pylist(), strict=True):
                    found = words(t)
                    if max(map(len, found), default=0) > LONGEST:
                        # Long words are not held; their n-grams are, all of them.
                        for w in found:
                            if len(w) > LONGEST:
                                for n in range(1, order + 1):
                                    longer.setdefault(language, Counter()).update(grams(w, n))
                        found = [w for w in found if len(w) <= LONGEST]
                        if full():
                            yield from drain()
                    held.setdefault(language, Counter()).update(found)
                if full():
                    yield from drain()
        yield from drain()

    rows = documents.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(text, F.col(lang).cast("string").alias(lang))
    return rows.mapInArrow(count, _COUNTS).groupBy("lang", "n", "key").agg(F.sum("count").alias("count"))


def gram_counts(words_counted: DataFrame, order: int = ORDER) -> DataFrame:
    """``(lang, n, key, count)`` of the n-grams of counted words, and of those that were counted already."""
    ship()

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[str, int]] = {}

        def drain() -> Iterator[pa.RecordBatch]:
            for language, found in held.items():
                yield from _rows(language, [], found)
            held.clear()

        for part in parts:
            for language, w, c in zip(*(part.column(k).to_pylist() for k in (0, 2, 3)), strict=True):
                found = held.get(language)
                if found is None:
                    found = held[language] = {}
                get = found.get
                for n in range(1, order + 1):
                    for g in grams(w, n):
                        found[g] = get(g, 0) + c
            if sum(map(len, held.values())) > HELD_COUNTS:
                yield from drain()
        yield from drain()

    found = words_counted.where("n = 0").mapInArrow(count, _COUNTS).unionByName(words_counted.where("n > 0"))
    return found.groupBy("lang", "n", "key").agg(F.sum("count").alias("count"))


def counts(documents: DataFrame, text: str = "text", lang: str = "lang", order: int = ORDER) -> DataFrame:
    """``(lang, n, key, count)``: words (n = 0) and n-grams of each language, over all documents; the word counts are checkpointed."""
    counted = checkpointed(word_counts(documents, text, lang, order))
    return counted.where("n = 0").unionByName(gram_counts(counted, order))


def fit(documents: DataFrame, text: str = "text", lang: str = "lang", most_words: int = WORDS, most_grams: int = GRAMS, order: int = ORDER) -> dict:
    """Languages, for each order a table from frequent words or n-grams to their log frequency in each language, and all counts."""
    counted = checkpointed(counts(documents, text, lang, order))
    totals = {(r["lang"], r["n"]): (r["c"], r["v"]) for r in counted.groupBy("lang", "n").agg(F.sum("count").alias("c"), F.count("*").alias("v")).collect()}
    languages = sorted({language for language, _ in totals})
    if not languages:
        return {"languages": [], "tables": {}, "unknown": {}, "complete": True}
    size = len(languages)
    most_words, most_grams = (min(most, CELLS // size) for most in (most_words, most_grams))
    rooms = {n: most_grams // (size * order) if n else most_words // size for n in range(order + 1)}
    # The least count, by language and order, above which the model has room for all: from the number of keys of each count.
    room = F.when(F.col("n") == 0, rooms[0]).otherwise(rooms[order])
    # As many rows as there are different counts.
    higher = Window.partitionBy("lang", "n").orderBy(F.desc("count"))
    fits = counted.groupBy("lang", "n", "count").agg(F.count("*").alias("keys")).withColumn("all", F.sum("keys").over(higher)).where(F.col("all") <= room)
    least = fits.groupBy("lang", "n").agg(F.min("count").alias("least"))
    kept = counted.join(F.broadcast(least), ["lang", "n"]).where("count >= least")
    # A key that one language keeps is scored with its counts in all of them.
    shared = counted.join(kept.select("n", "key").distinct(), ["n", "key"])
    unknown = {n: np.array([np.log(0.5 / (sum(totals.get((x, n), (0, 0))) + 1)) for x in languages]) for n in range(order + 1)}
    tables: dict[int, dict[str, np.ndarray]] = {n: {} for n in range(order + 1)}
    place = {language: k for k, language in enumerate(languages)}
    for r in shared.select("n", "key", "lang", "count").toLocalIterator():
        n, k = r["n"], place[r["lang"]]
        row = tables[n].setdefault(r["key"], unknown[n].copy())
        c, v = totals[r["lang"], n]
        row[k] = np.log((r["count"] + 0.5) / (c + v + 1))
    assert sum(map(len, tables.values())) <= (most_words + most_grams)
    return {
        "languages": languages, "tables": {n: (list(t), np.array(list(t.values()), np.float32).reshape(-1, size)) for n, t in tables.items()}, "unknown": unknown,
        "complete": all(v <= rooms[n] for (_, n), (_, v) in totals.items()), "totals": totals, "counts": counted,
    }


class Scorer:
    """Scores of texts by a model; remembers the n-grams of unseen words."""

    def __init__(self, model: dict, remembered: int = 100_000):
        self.languages, self.remembered = model["languages"], remembered
        tables = model["tables"]
        self.orders = sorted((n for n in tables if n), reverse=True)
        self.row = {w: k for k, w in enumerate(tables[0][0])} if tables else {}
        self.value = tables[0][1] if tables else None
        # N-grams of all orders in one table: their length tells them apart.
        names = [g for n in self.orders for g in tables[n][0]]
        self.gram = {g: k for k, g in enumerate(names)}
        self.gram_value = np.concatenate([tables[n][1] for n in self.orders]) if names else np.zeros((0, len(self.languages)))
        self.unseen: dict[str, list[int]] = {}

    def backoff(self, word: str) -> list[int]:
        """Places of the known n-grams of the longest order of which any is known."""
        found = self.unseen.get(word)
        if found is None:
            known, found = self.gram, []
            for n in self.orders:
                found = [known[g] for g in grams(word, n) if g in known]
                if found:
                    break
            if len(self.unseen) >= self.remembered:
                self.unseen.clear()
            self.unseen[word] = found
        return found

    def known(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """What the known words add in each language, and the places of the others."""
        rows = np.fromiter(map(self.row.get, tokens, repeat(-1)), np.int64, len(tokens))
        return self.value[rows[rows >= 0]].sum(axis=0, dtype=float), np.flatnonzero(rows < 0)

    def result(self, total: np.ndarray) -> dict:
        share = np.exp(total - total.max())
        best = int(np.argmax(total))
        return {"lang_pred": self.languages[best], "score": float(share[best] / share.sum())}

    def parts(self, text: bytes | None) -> dict:
        """What the known words add, and the others with how often they occur; no totals for a text without words."""
        tokens = words(text)
        if not tokens:
            return {"total": None, "rest": []}
        total, others = self.known(tokens)
        return {"total": total.tolist(), "rest": [{"word": w, "times": c} for w, c in Counter(map(tokens.__getitem__, others.tolist())).items()]}

    def __call__(self, text: bytes | None) -> dict:
        tokens = words(text)
        if not tokens or not self.languages:
            return {"lang_pred": "und", "score": 0.0}
        total, others = self.known(tokens)
        unseen = [*map(self.backoff, map(tokens.__getitem__, others.tolist()))]
        sizes = np.fromiter(map(len, unseen), np.int64, len(unseen))
        if sizes.any():
            places = np.fromiter(chain.from_iterable(unseen), np.int64, int(sizes.sum()))
            total = total + np.repeat(1 / sizes[sizes > 0], sizes[sizes > 0]) @ self.gram_value[places]
        return self.result(total)


def _entries(model: dict) -> DataFrame:
    """``(n, key, entries)`` of all words and n-grams: by how much each language that has a key is above those that don't."""
    place = {language: k for k, language in enumerate(model["languages"])}
    rows = [(lang, n, place[lang], float(c + v + 1), float(np.float32(model["unknown"][n][place[lang]]))) for (lang, n), (c, v) in model["totals"].items()]
    # A row for each language and order.
    sizes = F.broadcast(model["counts"].sparkSession.createDataFrame(rows, "lang string, n int, place int, all double, unknown double"))
    above = F.log((F.col("count") + 0.5) / F.col("all")).cast("float").cast("double") - F.col("unknown")
    return model["counts"].join(sizes, ["lang", "n"]).groupBy("n", "key").agg(F.collect_list(F.struct("place", above.alias("v"))).alias("entries"))


def _grams_of(order: int):
    def run(column: pa.Array) -> pa.Array:
        found = [[{"key": g, "times": c} for g, c in Counter(grams(w, order)).items()] for w in column.to_pylist()]
        return pa.array(found, pa.list_(pa.struct([("key", pa.string()), ("times", pa.int64())])))

    return arrow_function(run, "array<struct<key:string,times:bigint>>")


def resolved(rest: DataFrame, model: dict) -> DataFrame:
    """``(word, entries)`` of distinct words by the counts of all words and n-grams: a word's own, or the average over its known
    n-grams of the longest order of which any is known. The entry ``(-1 - n, 1)`` tells the order; words without any have no row.
    """
    entries = _entries(model)
    mark = lambda n: F.array(F.struct(F.lit(-1 - n).alias("place"), F.lit(1.0).alias("v")))
    found = checkpointed(rest.join(entries.where("n = 0").select(F.col("key").alias("word"), "entries"), "word").select("word", F.concat(mark(0), "entries").alias("entries")))
    left, out = rest.join(found, "word", "left_anti"), found
    for n in sorted((n for n in model["tables"] if n), reverse=True):
        left = checkpointed(left)
        hits = left.select("word", F.inline(_grams_of(n)("word"))).join(entries.where(F.col("n") == n).select("key", "entries"), "key")
        # Summed with how many n-grams are known, by which it is divided.
        sums = hits.select("word", "times", F.inline(F.concat(mark(n), "entries"))).groupBy("word", "place").agg(F.sum(F.col("times") * F.col("v")).alias("v"))
        whole = sums.groupBy("word").agg(F.collect_list(F.struct("place", "v")).alias("x"), F.max(F.when(F.col("place") < 0, F.col("v"))).alias("known"))
        found = checkpointed(whole.select("word", F.transform("x", lambda e: F.struct(e["place"].alias("place"), (e["v"] / F.col("known")).alias("v"))).alias("entries")))
        left, out = left.join(found, "word", "left_anti"), out.unionByName(found)
    return out


def _apply_joined(documents: DataFrame, model: dict, light: dict, text: str, keep_text: bool) -> DataFrame:
    """As ``apply`` where not all is broadcast: words that aren't are joined, once for each document."""
    shared = documents.sparkSession.sparkContext.broadcast(light)

    def make():
        scorer = Scorer(shared.value)
        return lambda texts: [scorer.parts(t) for t in texts]

    parts = text_function(make, "struct<total:array<double>,rest:array<struct<word:string,times:bigint>>>")
    scored = documents.select("*", F.monotonically_increasing_id().alias("_row"), parts(text).alias("_parts"))
    scored = written(scored if keep_text else scored.drop(text), "language")
    rest = scored.select("_row", F.inline("_parts.rest"))
    values = rest.join(resolved(checkpointed(rest.select("word").distinct()), model), "word").select("_row", "times", F.inline("entries"))
    sums = values.groupBy("_row", "place").agg(F.sum(F.col("times") * F.col("v")).alias("v"))
    more = sums.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("place", "v"))).alias("_more"))

    kind = arrow_type(_RESULT)

    def finish(totals: pa.Array, mores: pa.Array) -> pa.Array:
        scorer, out = Scorer(shared.value), []
        unknown = {n: np.float32(u).astype(float) for n, u in shared.value["unknown"].items()}
        for total, entries in zip(totals.to_pylist(), mores.to_pylist(), strict=True):
            if total is None:
                out.append({"lang_pred": "und", "score": 0.0})
                continue
            total = np.array(total)
            for e in entries or ():
                if e["place"] < 0:
                    total += e["v"] * unknown[-1 - e["place"]]
                else:
                    total[e["place"]] += e["v"]
            out.append(scorer.result(total))
        return pa.array(out, kind)

    return scored.join(more, "_row", "left").withColumn("_lang", arrow_function(finish, _RESULT)("_parts.total", "_more")).drop("_row", "_parts", "_more")


_RESULT = "struct<lang_pred:string,score:double>"


def apply(documents: DataFrame, model: dict, text: str = "text", keep_text: bool = True) -> DataFrame:
    """Documents with ``lang_pred`` and ``score``, the share of that language among all if each were as likely at first."""
    light = {k: v for k, v in model.items() if k not in ("counts", "totals")}
    documents, now, back = aside(documents, "_row", "_parts", "_more", "_lang")
    text = now(text)
    if model["complete"]:
        shared = documents.sparkSession.sparkContext.broadcast(light)

        def make():
            scorer = Scorer(shared.value)
            return lambda texts: [scorer(t) for t in texts]

        found = documents.withColumn("_lang", text_function(make, _RESULT)(text))
    else:
        found = _apply_joined(documents, model, light, text, keep_text)
    return back(found.withColumns({"lang_pred": F.col("_lang.lang_pred"), "score": F.col("_lang.score")}).drop("_lang"))


def op5(spark, sf_dir: str) -> DataFrame:
    """Language of every document, learned without the held-out ones."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(documents.where(remainder("doc_id", HELD_OUT[0]) != HELD_OUT[1]))
    held = F.coalesce(remainder("doc_id", HELD_OUT[0]) == HELD_OUT[1], F.lit(False))
    return apply(documents.drop("lang"), model, keep_text=False).select("doc_id", held.alias("held_out"), "lang_pred", "score")
