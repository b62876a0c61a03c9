"""Periodic runs of words by recursive frequency splitting.

A run is a stretch of consecutive words with smallest period q that is at least ``max(LEAST, COPIES * q)`` words long and that no
neighbouring word extends. Each word of a run occurs in it ``COPIES`` times at least. So a word that a segment holds fewer times is
in none of the segment's runs and splits it; what is left is counted anew, until no segment changes. Most texts have nothing left.

The segments that survive are scanned at every lag q they have room for. A run of period q holds two neighbouring blocks of q words
at multiples of q, equal to one another; block sums of two hashes find such places, m / q of them at lag q, so all lags of m words take
m log m steps. Places whose window has a shorter period belong to that period's run. What is found is compared word by word and
extended to its ends.

Texts stay next to the scan; a task holds one text at a time. Nothing is shuffled.

Defined results: a null text has no words and no run; words are what stands between ASCII blanks; one text's result doesn't depend
on other rows, so repeated rows, null ids and extra columns are as good as any.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cif_lake.llm.common import arrow_function, arrow_type, batches, release, table

LEAST, COPIES = 6, 4
#: A prime below 2^31, so that products fit in 64 bits, and two bases of the block sums.
PRIME, BASES = (1 << 31) - 1, (1_234_567_891, 987_654_323)
#: Shorter segments are counted without numpy.
SMALL = 200


def segments(codes: np.ndarray) -> list[tuple[int, int]]:
    """Stretches ``[start, end)`` in which every word occurs ``COPIES`` times at least; all runs lie inside of them."""
    stable, todo = [], [(0, len(codes))]
    while todo:
        start, end = todo.pop()
        if end - start < LEAST:
            continue
        part = codes[start:end]
        if end - start < SMALL:
            own = part.tolist()
            held = Counter(own)
            rare = [i for i, c in enumerate(own) if held[c] < COPIES]
        else:
            _, inverse, counts = np.unique(part, return_inverse=True, return_counts=True)
            rare = np.flatnonzero(counts[inverse] < COPIES).tolist()
        if not rare:
            stable.append((start, end))
            continue
        before = -1
        for at in [*rare, end - start]:
            if at - before > LEAST:
                todo.append((start + before + 1, start + at))
            before = at
    return sorted(stable)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, np.int64)
    while len(out) < n:
        step = pow(base, len(out), PRIME)
        out = np.concatenate([out, out * step % PRIME])
    return out[:n]


class _Sums:
    """Hashes of any block of a sequence, comparable between blocks of one width."""

    def __init__(self, codes: np.ndarray):
        self.powers = [_powers(b, len(codes) + 1) for b in BASES]
        mixed = (codes.astype(np.int64) + 1) * 40_503 % PRIME
        self.before = [np.concatenate([[0], np.cumsum(mixed * p[:-1] % PRIME) % PRIME]) for p in self.powers]

    def equal(self, first: np.ndarray, shift: int, width: int) -> np.ndarray:
        """Whether ``width`` words from each of ``first`` equal those ``shift`` further on, as far as hashes tell."""
        out = np.ones(len(first), bool)
        for sums, powers in zip(self.before, self.powers):
            here = (sums[first + width] - sums[first]) % PRIME
            there = (sums[first + shift + width] - sums[first + shift]) % PRIME
            out &= here * powers[shift] % PRIME == there
        return out


def _prime_factors(n: int) -> list[int]:
    out, p = [], 2
    while p * p <= n:
        if n % p == 0:
            out.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return [*out, n] if n > 1 else out


def _matching(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading words of two stretches agree; reads little beyond them."""
    done, step, n = 0, 64, min(len(a), len(b))
    while done < n:
        differ = np.flatnonzero(a[done : done + step] != b[done : done + step])
        if len(differ):
            return done + int(differ[0])
        done, step = min(n, done + step), step * 2
    return n


def lag_scan(codes: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs ``(start, length, period)`` of one segment."""
    n, found = len(codes), []
    sums = _Sums(codes)
    for q in range(1, n // COPIES + 1):
        first = np.arange(0, n - 2 * q + 1, q)
        first = first[codes[first] == codes[first + q]]
        if len(first):
            first = first[sums.equal(first, q, q)]
        if not len(first):
            continue
        for p in _prime_factors(q):
            shorter = q // p
            first = first[~sums.equal(first, shorter, 2 * q - shorter)]
        end = 0
        for at in first.tolist():
            if at + q < end:
                continue
            right = at + _matching(codes[at : n - q], codes[at + q :])
            left = at - _matching(codes[:at][::-1], codes[q : at + q][::-1])
            end = right + q
            if end - left >= max(LEAST, COPIES * q):
                found.append((left, end - left, q))
    return found


def runs(words: list[bytes]) -> list[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` of a sequence of words, by start, then period."""
    if len(words) < LEAST:
        return []
    names: dict[bytes, int] = {}
    codes = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, len(words))
    out = []
    for start, end in segments(codes):
        out += [(start + s, length, q) for s, length, q in lag_scan(codes[start:end])]
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay when each run is collapsed to its first period."""
    edges = np.zeros(n + 1, np.int64)
    for start, length, q in found:
        edges[start + q] += 1
        edges[start + length] -= 1
    return np.cumsum(edges[:-1]) == 0


def strongest(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length by period; ties go to the smallest start, then period."""
    best = None
    for run in found:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def looped(words: list[bytes], checksum: int | None) -> list[bytes]:
    """The words with the loop that a checksum of the id plants: one row in ten repeats itself from some word on."""
    n = len(words)
    if checksum is None or checksum % 10 or not n:
        return words
    g = checksum // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % period] for i in range(n - a)]


_RUN = "struct<start:bigint,length:bigint,period:bigint>"


def detect(documents: DataFrame, text: str = "text", name: str = "periodic", collapse: bool = True, seed=None) -> DataFrame:
    """The documents with a struct column ``name``: ``n_words``, ``runs`` by start and period, ``best`` and the ``collapsed`` text.

    ``collapsed`` is the kept words joined by one blank (null unless ``collapse``). ``seed`` is a column of checksums for ``looped``.
    A column that is called ``name`` already is replaced.
    """
    schema = f"struct<n_words:bigint,runs:array<{_RUN}>,best:{_RUN},collapsed:binary>"
    to = arrow_type(schema)
    as_struct = lambda r: None if r is None else {"start": r[0], "length": r[1], "period": r[2]}

    def one(text: bytes | None, checksum: int | None) -> dict:
        words = looped((text or b"").split(), checksum)
        found = runs(words)
        if not collapse:
            left = None
        elif found:
            stay = kept(len(words), found)
            left = b" ".join([words[i] for i in np.flatnonzero(stay)])
        else:
            left = b" ".join(words)
        return {"n_words": len(words), "runs": [as_struct(r) for r in found], "best": as_struct(strongest(found)), "collapsed": left}

    def run(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for texts, checksums in columns:
            start, parts = 0, []
            for part in batches(texts):
                seeds = checksums.slice(start, len(part)).to_pylist()
                start += len(part)
                parts.append(pa.array([one(t, c) for t, c in zip(part, seeds)], to))
            yield pa.concat_arrays([pa.array([], to), *parts])
        release()

    checksum = F.lit(None).cast("bigint") if seed is None else seed.cast("bigint")
    return documents.withColumn(name, arrow_function(run, schema)(F.col(text).cast("string"), checksum))


def collapse(documents: DataFrame, text: str = "text") -> DataFrame:
    """The documents with every run cut to its first period; a text without runs, and a null one, stays as it is."""
    columns = documents.columns
    packed = documents.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(f"`{text}`").alias("text"))
    done = detect(packed, "text", "found")
    new = F.when(F.size("found.runs") > 0, F.col("found.collapsed").cast("string")).otherwise(F.col("text"))
    return done.select(*[(new.alias(c) if c == text else F.col(f"row.`{c}`").alias(c)) for c in columns])


def _digest(found: list[tuple[int, int, int]]) -> str:
    return hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in found).encode()).hexdigest()


def op13(spark, sf_dir: str) -> DataFrame:
    """Runs of every document with its planted loop."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    checksum = F.crc32(F.col("doc_id").cast("string"))
    found = detect(docs, seed=checksum)
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    listed = F.array_join(F.transform("periodic.runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.select(
        "doc_id",
        F.size("periodic.runs").cast("bigint").alias("n_runs"),
        F.col("periodic.best.start").alias("start"),
        F.col("periodic.best.length").alias("length"),
        F.col("periodic.best.period").alias("period"),
        F.floor(1000 * F.col("periodic.best.length") / F.col("periodic.best.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2("periodic.collapsed", 256).alias("collapsed_sha256"),
    )
