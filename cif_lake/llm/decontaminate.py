"""Benchmark decontamination: a broadcast hash set of normalised benchmark n-grams, scanned over the words of all documents.

Words are runs of bytes outside the ASCII punctuation, after lower-casing A-Z. Each run of ``n`` consecutive words of an item is a
window; an item of fewer words is one window as a whole. The distinct windows of the benchmark become a sorted array of 64-bit
rolling hashes that is broadcast. A document is scanned once: its words are numbered by the benchmark's vocabulary, windows of known
words are hashed with numpy, hashes that are found are verified word by word.

The benchmark is cut into blocks of ``block_bytes`` of text on average, and the documents are scanned once per block, so what is
broadcast does not grow with the benchmark. Every block adds to the hits of the ones before it.

Defined results: a null or empty text has no words; an item without a word has no window; an item without an id marks words but
is not listed; repeated items count once. Result columns replace input columns of the same name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cif_lake.llm.common import aside, arrow_function, arrow_type, batches, checkpointed, release, table

#: Bytes: A-Z to a-z, other ASCII but 0-9 a-z to a blank, the rest as it is.
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
WINDOW = 10
BLOCK_BYTES = 4 << 20
#: Words that are scanned in one go; their objects stay in the processor's cache.
CHUNK = 1 << 15


def words(text: bytes | None) -> list[bytes]:
    return text.translate(NORMAL).split() if text else []


def rolling(ids: np.ndarray, starts: np.ndarray, length: int, base: np.uint64) -> np.ndarray:
    """Polynomial hash, modulo 2**64, of ``length`` ids from each start."""
    out = np.zeros(len(starts), np.uint64)
    for k in range(length):
        out = out * base + ids[starts + k]
    return out


class Windows:
    """The distinct windows of a block of items."""

    def __init__(self, items: list[tuple[str | None, bytes | None]], n: int):
        self.items = sorted({i for i, _ in items if i is not None})
        number = {i: k for k, i in enumerate(self.items)}
        split = [(number.get(i, -1), words(t)) for i, t in items]
        self.vocabulary: dict[bytes, int] = {}
        for _, tokens in split:
            for w in tokens:
                self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
        by_length: dict[int, list[tuple[int, int]]] = {}
        flat: list[int] = []
        for item, tokens in split:
            length = min(n, len(tokens))
            if length:
                by_length.setdefault(length, []).extend((len(flat) + k, item) for k in range(len(tokens) - length + 1))
            flat.extend(map(self.vocabulary.__getitem__, tokens))
        self.ids = np.array(flat, np.uint64)
        self.tables = {length: self._table(np.array(found, np.int64), length) for length, found in by_length.items()}

    def _table(self, found: np.ndarray, length: int):
        """Base, sorted hashes, a place of each window, and its items; the base is one under which no two windows collide."""
        base = np.uint64(0x9E3779B97F4A7C15)
        while True:
            hashes = rolling(self.ids, found[:, 0], length, base)
            distinct, first, group = np.unique(hashes, return_index=True, return_inverse=True)
            place = found[first, 0]
            if all((self.ids[found[:, 0] + k] == self.ids[place[group] + k]).all() for k in range(length)):
                break
            base += np.uint64(2)
        pairs = np.unique(np.stack([group, found[:, 1]], 1), axis=0)
        pairs = pairs[pairs[:, 1] >= 0]
        return base, distinct, place, np.searchsorted(pairs[:, 0], np.arange(len(distinct) + 1)), pairs[:, 1]

    def scan(self, texts: list[list[bytes]]) -> list[tuple[list[tuple[int, int]], list[str]]]:
        """For each list of words, the merged spans of words inside windows and the items of those windows."""
        sizes = [len(t) for t in texts]
        # Texts are kept apart by an unknown word.
        starts = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64) + 1)])
        joined = [w for tokens in texts for w in (*tokens, b"")]
        ids = np.fromiter(map(self.vocabulary.get, joined, repeat(0)), np.int64, len(joined)).astype(np.uint64)
        unknown = np.concatenate([[0], np.cumsum(ids == 0)])
        edge = np.zeros(len(ids) + 1, np.int64)
        listed = []
        for length, (base, distinct, place, first, item) in self.tables.items():
            at = np.flatnonzero(unknown[length:] == unknown[:-length])
            hashes = rolling(ids, at, length, base)
            near = np.minimum(np.searchsorted(distinct, hashes), len(distinct) - 1)
            sure = distinct[near] == hashes
            at, near = at[sure], near[sure]
            sure = np.ones(len(at), bool)
            for k in range(length):
                sure &= ids[at + k] == self.ids[place[near] + k]
            at, near = at[sure], near[sure]
            np.add.at(edge, at, 1)
            np.add.at(edge, at + length, -1)
            text = np.searchsorted(starts, at, "right") - 1
            for t, w in set(zip(text.tolist(), near.tolist(), strict=True)):
                listed.extend((t, i) for i in item[first[w] : first[w + 1]].tolist())
        inside = np.concatenate([[0], (np.cumsum(edge)[:-1] > 0).astype(np.int8), [0]])
        begin, end = np.flatnonzero(np.diff(inside) == 1), np.flatnonzero(np.diff(inside) == -1)
        out: list[tuple[list, list]] = [([], []) for _ in texts]
        for t, b, e in zip((np.searchsorted(starts, begin, "right") - 1).tolist(), begin.tolist(), end.tolist(), strict=True):
            out[t][0].append((b - int(starts[t]), e - int(starts[t])))
        for t, i in set(listed):
            out[t][1].append(self.items[i])
        return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for b, e in sorted(spans):
        if out and b <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((b, e))
    return out


_FOUND = "struct<n_words:bigint,spans:array<struct<start:int,end:int>>,items:array<string>>"


def _scanner(block, first: bool):
    kind = arrow_type(_FOUND)

    def run(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        found = block.value
        for texts, before in columns:
            earlier = iter(before.to_pylist())
            rows, chunk, size = [], [], 0

            def flush(chunk: list, rows: list, earlier=earlier) -> None:
                for tokens, (spans, items) in zip(chunk, found.scan(chunk), strict=True):
                    old = next(earlier)
                    if not first:
                        spans = merged(spans + [(s["start"], s["end"]) for s in old["spans"]])
                        items = set(items) | set(old["items"])
                    rows.append({"n_words": len(tokens), "spans": [{"start": b, "end": e} for b, e in spans], "items": sorted(items)})

            for part in batches(texts):
                for text in part:
                    chunk.append(words(text))
                    size += len(chunk[-1])
                    if size > CHUNK:
                        flush(chunk, rows)
                        chunk, size = [], 0
            flush(chunk, rows)
            yield pa.array(rows, kind)
        release()

    return arrow_function(run, _FOUND)


def find(documents: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item: str = "text", n: int = WINDOW, block_bytes: int = BLOCK_BYTES, name: str = "leaks") -> DataFrame:
    """Documents with a column ``leaks``: ``n_words``, merged ``spans`` of words inside windows (end exclusive), sorted ``items``."""
    spark = documents.sparkSession
    total = benchmark.agg(F.sum(F.octet_length(item) + 1)).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    key = F.pmod(F.xxhash64(F.col(item_id).cast("string"), F.col(item)), F.lit(blocks))
    out = documents.withColumn(name, F.lit(None).cast(_FOUND))
    for block in range(blocks):
        rows = benchmark.where(key == block).select(F.col(item_id).cast("string"), F.col(item).cast("binary")).distinct().collect()
        windows = spark.sparkContext.broadcast(Windows([(r[0], bytes(r[1]) if r[1] is not None else None) for r in rows], n))
        if block:
            out = checkpointed(out)
        out = out.withColumn(name, _scanner(windows, block == 0)(text, name))
    return out


def n_hit(leaks: str = "leaks") -> Column:
    return F.aggregate(F.col(f"{leaks}.spans"), F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])


def remove_documents(documents: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents in which no window occurs."""
    documents, now, back = aside(documents, "_leaks")
    return back(find(documents, benchmark, now(text), name="_leaks", **options).where(F.size("_leaks.spans") == 0).drop("_leaks"))


def remove_spans(documents: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """All documents, with the words inside windows cut out of the text; what stood on either side is kept apart by a newline.

    Cutting can bring words together that form another window; such a text is returned with that window in it. Apply again to
    remove it.
    """

    def cut(texts: pa.Array, leaks: pa.Array) -> pa.Array:
        import re

        place = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
        out = []
        for raw, found in zip(texts.cast(pa.binary()).to_pylist(), leaks.to_pylist(), strict=True):
            if raw and found["spans"]:
                at = [m.span() for m in place.finditer(raw)]
                kept, last = [], 0
                for s in found["spans"]:
                    kept.append(raw[last : at[s["start"]][0]])
                    last = at[s["end"] - 1][1]
                raw = b"\n".join([*kept, raw[last:]])
            out.append(None if raw is None else raw.decode())
        return pa.array(out, pa.string())

    cutter = arrow_function(cut, "string")
    documents, now, back = aside(documents, "_leaks")
    text = now(text)
    return back(find(documents, benchmark, text, name="_leaks", **options).withColumn(text, cutter(text, "_leaks")).drop("_leaks"))


def op1(spark, sf_dir: str) -> DataFrame:
    """Contamination of every document by the benchmark."""
    found = find(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        F.col("leaks.n_words").alias("n_words"),
        n_hit().alias("n_hit"),
        F.size("leaks.items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "leaks.items").cast("binary"), 256).alias("items_sha256"),
        (F.size("leaks.spans") > 0).alias("contaminated"),
    )


#: op1 in DuckDB's SQL: all windows spelled out and joined by text.
OP1_SQL = r"""
WITH doc AS (
  SELECT doc_id, rowid_ AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT *, row_number() OVER () AS rowid_ FROM documents)
), item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS l, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS t
  FROM item, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS u(i) WHERE len(w) > 0
), seen AS (
  SELECT r, l, i, array_to_string(w[i:i + l - 1], ' ') AS t
  FROM doc, (SELECT DISTINCT l FROM windows), unnest(range(1, len(w) - l + 2)) AS u(i) WHERE len(w) >= l
), hits AS (SELECT r, l, i, item_id FROM seen JOIN windows USING (l, t)),
marked AS (SELECT r, count(DISTINCT i + k) AS n FROM hits, unnest(range(0, l)) AS u(k) GROUP BY r),
listed AS (SELECT r, count(*) AS n, string_agg(x, ',' ORDER BY x) AS s FROM (SELECT DISTINCT r, item_id::VARCHAR AS x FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(marked.n, 0)::BIGINT AS n_hit, coalesce(listed.n, 0)::BIGINT AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, marked.n IS NOT NULL AS contaminated
FROM doc LEFT JOIN marked USING (r) LEFT JOIN listed USING (r)
"""
