"""Scoring by a hierarchical Pitman-Yor model of words.

The ``HEAD`` most frequent words, the end of a text and the class of all other words are the dishes. Every one of them, and the start
of a text, is a context with a restaurant of its own; all restaurants share one parent, whose customers are their tables and whose base
is uniform. A word of the class is then drawn from one more restaurant over the other known words and one outcome for all unknown
ones, again with a uniform base; its discount is zero, so its predictions do not depend on the seating, and its strength is the
one of a grid under which the counts, each left out in turn, are likeliest.

Seating is sampled by Gibbs. All that predictions need of the customers of a dish in a restaurant is at how many tables they sit, and
given the other tables of the restaurant that number has a known distribution (generalised Stirling numbers times the weights of the
tables): a sweep draws it anew for every dish of every restaurant, which reseats all customers. A customer alone in its dish has one table.
Dishes of one sweep see the other tables and the parent as the sweep before left them, so a sweep needs no shuffle. Stirling numbers are exact
up to ``EXACT`` customers; beyond, they come from the saddle point of their generating function, put right by what that misses
for ``EXACT`` customers at as many tables in proportion to ``count ** discount``.
Predictive probabilities are averaged over the sweeps that follow the first ``BURN``.

Word counts and pairs (context, dish) cover the whole training corpus and are kept as tables that grow with it. Pairs lie in buckets by a
hash of both words, as many as keep a bucket at ``BUCKET_TOKENS`` training tokens, so a frequent context is spread over all buckets; sorted
lists of them are summed inside a partition before they are shuffled. Broadcast are only the ``KNOWN`` most frequent words (none
longer than ``LONGEST`` bytes), two numbers a sample for each dish and context, and the ``PAIRS`` most frequent pairs; a document's other
pairs and words meet the tables by shuffle, once for each document they occur in. The most frequent ones are those above a count that
leaves no more than there is room for.

Defined results: a null or empty text is the end alone; a null id is not learned from; without training texts the classes are
uniform and all words are unknown. Result columns replace input columns of the same name.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cif_lake.llm.common import aside, SLICE, arrow_function, arrow_type, batches, checkpointed, release, remainder, ship, table, written

HEAD, KNOWN, LONGEST, PAIRS = 200_000, 200_000, 64, 1_000_000
BURN, SAMPLES, SEED = 2, 3, 11
STRENGTH, PARENT_DISCOUNT = 1.0, 0.5
#: Words that a partition counts before it passes them on.
HELD_COUNTS = 400_000
#: Pairs that a partition holds before it passes them on, and training tokens for each bucket of pairs.
HELD_PAIRS, BUCKET_TOKENS = 1_000_000, 1_000_000
#: Customers of one dish up to which the distribution of their tables is exact.
EXACT = 200
#: The end of a text among the words; no word contains it.
END = "\n"
HELD_OUT = (7, 2)


def words(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


def word_counts(texts: DataFrame) -> DataFrame:
    """``(word, count)`` over the column ``text``, one end for each text."""
    ship()

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def drain() -> Iterator[pa.RecordBatch]:
            while held:
                some = [held.popitem() for _ in range(min(50_000, len(held)))]
                yield pa.RecordBatch.from_arrays([pa.array([w.decode(errors="replace") for w, _ in some]), pa.array([c for _, c in some], pa.int64())], ["word", "count"])

        for part in parts:
            for chunk in batches(part.column(0)):
                for text in chunk:
                    held.update(words(text))
                    held[END.encode()] += 1
                if len(held) > HELD_COUNTS:
                    yield from drain()
        yield from drain()

    return texts.select("text").mapInArrow(count, "word string, count long").groupBy("word").agg(F.sum("count").alias("count"))


def most_frequent(counts: DataFrame, room: int) -> list[tuple[str, int]]:
    """The words above the least count that leaves ``room`` or fewer, by falling count."""
    short = counts.where((F.col("word") != END) & (F.octet_length("word") <= LONGEST))
    # As many rows as there are different counts.
    fits = short.groupBy("count").agg(F.count("*").alias("words")).withColumn("all", F.sum("words").over(Window.orderBy(F.desc("count")))).where(F.col("all") <= room)
    least = fits.agg(F.min("count")).first()[0]
    rows = short.where(F.col("count") >= least).collect() if least is not None else []
    return sorted(((r["word"], r["count"]) for r in rows), key=lambda x: (-x[1], x[0]))


#: Share of the strength that falls on each outcome of the restaurant of other words.
PSEUDO = [0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 1.0, 1.4, 2.0]


def pseudo_count(counts_of_counts: list[tuple[int, int]]) -> float:
    """The share of ``PSEUDO`` with the highest probability of every token of the other words given the rest."""
    c, n = (np.array(x, float) for x in zip(*counts_of_counts, strict=True)) if counts_of_counts else (np.zeros(0), np.zeros(0))
    total, different = float(c @ n), float(n.sum())
    return max(PSEUDO, key=lambda a: float(n * c @ (np.log(c - 1 + a) - np.log(max(1, total - 1) + a * (different + 1)))))


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function of positive numbers, by Stirling's series six places higher."""
    y = x + 6
    low = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - np.log(low)


class Seating:
    """Draws at how many tables the customers of a dish sit, given what else there is in their restaurant."""

    def __init__(self, discount: float, exact: int = EXACT):
        self.discount, self.exact = discount, exact
        # stirling[c, t]: log of the generalised Stirling number of c customers at t tables.
        self.stirling = np.full((exact + 1, exact + 1), -np.inf)
        self.stirling[1, 1] = 0
        t = np.arange(1, exact + 1)
        for c in range(1, exact):
            stay = np.log(np.maximum(c - discount * t, 1e-300)) + self.stirling[c, 1:]
            self.stirling[c + 1, 1:] = np.logaddexp(self.stirling[c, :-1], stay)
            self.stirling[c + 1, c + 2 :] = -np.inf
        # The saddle point of x at each share u of tables among customers, by y = 1 - x from close to 0 to close to 1.
        log_y = -np.geomspace(600 / (2 - discount), 1e-7, 20_000)
        y, x = np.exp(log_y), -np.expm1(log_y)
        log_f = np.log(-np.expm1(discount * log_y) / discount)
        mean = np.exp(np.log(x) + (discount - 1) * log_y - log_f)
        spread = np.exp(2 * np.log(x) + np.log1p(-discount) + (discount - 2) * log_y - log_f) + mean - mean**2
        self.share, self.slope, self.spread = 1 / mean, log_f, np.log(np.maximum(spread, 1e-300))
        self.height = self.share * log_f - np.log(x)
        places = t.astype(float)
        self.error = np.zeros(exact)
        self.error = self.stirling[exact, 1:] - self._log_stirling(places, np.full(exact, float(exact)))

    def draw(self, counts: np.ndarray, others: np.ndarray, base: np.ndarray, uniform: np.ndarray) -> np.ndarray:
        """Numbers of tables. ``others``: tables of other dishes; ``base``: the dish's probability in the parent."""
        tables = np.minimum(counts, 1)
        order = np.argsort(counts, kind="stable")
        ordered = counts[order]
        for c in np.unique(ordered[(ordered > 1) & (ordered <= self.exact)]).tolist():
            group = order[slice(*np.searchsorted(ordered, [c, c + 1]))]
            for start in range(0, len(group), 100_000):
                rows = group[start : start + 100_000]
                new = np.log(STRENGTH + self.discount * (others[rows, None] + np.arange(c))) + np.log(base[rows, None])
                tables[rows] = 1 + self._chosen(self.stirling[c, 1 : c + 1] + np.cumsum(new, axis=1), uniform[rows])[0]
        many = order[np.searchsorted(ordered, self.exact, "right") :]
        for start in range(0, len(many), 10_000):
            rows = many[start : start + 10_000]
            tables[rows] = self._many(counts[rows].astype(float), others[rows] + STRENGTH / self.discount, np.log(base[rows]), uniform[rows])
        return tables

    @staticmethod
    def _chosen(logs: np.ndarray, uniform: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A column for each row, by the logarithms of their weights, and what is left of the uniform number, again uniform."""
        weights = np.cumsum(np.exp(logs - logs.max(axis=1, keepdims=True)), axis=1)
        at = uniform * weights[:, -1]
        chosen = np.minimum((weights <= at[:, None]).sum(axis=1), logs.shape[1] - 1)
        every = np.arange(len(chosen))
        upper = weights[every, chosen]
        lower = np.where(chosen > 0, weights[every, chosen - 1], 0.0)
        return chosen, np.clip((at - lower) / np.maximum(upper - lower, 1e-300), 0, 1 - 1e-12)

    def _log_stirling(self, t: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Of generalised Stirling numbers, but for a constant: the saddle point and what it misses in the last exact row."""
        u = t / counts
        k = np.clip(np.searchsorted(self.share, u), 1, len(self.share) - 1)
        wide = self.share[k] - self.share[k - 1]
        at = np.clip((u - self.share[k - 1]) / wide, 0, 1)
        # A cubic through both ends with their slopes.
        low, high = self.height[k - 1], self.height[k]
        rise = wide * self.slope[k - 1] - (high - low), (high - low) - wide * self.slope[k]
        height = low + at * (high - low) + at * (1 - at) * (rise[0] * (1 - at) + rise[1] * at)
        spread = self.spread[k - 1] + at * (self.spread[k] - self.spread[k - 1])
        like = np.log(np.maximum(t * (self.exact / counts) ** self.discount, 1e-9))
        last = np.minimum(np.floor(np.exp(np.maximum(like, 0))).astype(np.int64), self.exact - 1)
        error = np.where(like >= np.log(self.exact), self.error[-1], self.error[last - 1] + (like - np.log(last)) / np.log1p(1 / last) * (self.error[last] - self.error[last - 1]))
        return counts * height - log_gamma(t + 1) - 0.5 * np.maximum(np.log(t) + spread, 0) + error

    def log_weight(self, t: np.ndarray, counts: np.ndarray, others: np.ndarray, base: np.ndarray) -> np.ndarray:
        """Of ``t`` tables for more than ``exact`` customers, but for a constant; ``others`` holds the strength, ``base`` is a logarithm."""
        return self._log_stirling(t, counts) + log_gamma(others + t) + t * (np.log(self.discount) + base)

    def _many(self, counts: np.ndarray, others: np.ndarray, base: np.ndarray, uniform: np.ndarray) -> np.ndarray:
        low, high = np.ones(len(counts)), counts.copy()
        for _ in range(int(np.ceil(np.log2(counts.max()))) + 1):
            middle = np.floor((low + high) / 2)
            rises = (self.log_weight(middle + 1, counts, others, base) > self.log_weight(middle, counts, others, base)) & (middle < high)
            low, high = np.where(rises, middle + 1, low), np.where(rises, high, middle)
        # 129 steps around the likeliest number, eight deviations wide; steps of more than one table are filled evenly.
        wide = np.sqrt(np.minimum(low * (others + low) / others, low * low))
        step = np.maximum(1, np.ceil(wide / 8))
        grid = low[:, None] + step[:, None] * np.arange(-64, 65)
        logs = self.log_weight(np.maximum(grid, 1), counts[:, None], others[:, None], base[:, None])
        logs[(grid < 1) | (grid > counts[:, None])] = -np.inf
        chosen, left = self._chosen(logs, uniform)
        found = grid[np.arange(len(low)), chosen] + np.floor((left - 0.5) * step + 0.5)
        return np.clip(found, 1, counts).astype(np.int64)


class Parent:
    """The restaurant that all contexts share; its customers are their tables."""

    def __init__(self, dishes: int, seed: int = SEED):
        self.dishes, self.rng, self.seating = dishes, np.random.default_rng([seed, 0]), Seating(PARENT_DISCOUNT)
        self.customers = self.tables = np.zeros(dishes, np.int64)

    def predictive(self) -> np.ndarray:
        new = (STRENGTH + PARENT_DISCOUNT * self.tables.sum()) / self.dishes
        return (self.customers - PARENT_DISCOUNT * self.tables + new) / (STRENGTH + self.customers.sum())

    def follow(self, customers: np.ndarray) -> None:
        """Take the customers of each dish as given, and seat all of them anew."""
        self.customers, old = customers, np.minimum(self.tables, customers)
        others = (old.sum() - old).astype(float)
        self.tables = self.seating.draw(customers, others, np.full(self.dishes, 1 / self.dishes), self.rng.random(self.dishes))


def packed(numbers: np.ndarray, rising: bool = False) -> bytes:
    """Whole numbers, or the differences of rising ones, byte by byte, deflated."""
    plain = np.diff(numbers, prepend=0) if rising else numbers
    return zlib.compress(np.ascontiguousarray(plain.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unpacked(data: bytes, rising: bool = False) -> np.ndarray:
    raw = np.frombuffer(zlib.decompress(data), np.uint8)
    plain = np.ascontiguousarray(raw.reshape(8, len(raw) // 8).T).view("<i8").reshape(-1)
    return np.cumsum(plain) if rising else plain.astype(np.int64)


def _bucket(codes: np.ndarray, buckets: int) -> np.ndarray:
    return (codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % buckets


def _by_bucket(codes: np.ndarray, buckets: int, names: list[str], *more: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row for each bucket: its number, its codes in rising order, and what belongs to them."""
    number = _bucket(codes, buckets)
    order = np.lexsort((codes, number))
    number = number[order]
    starts = np.flatnonzero(np.diff(number, prepend=-1)).tolist()
    for some in range(0, len(starts), 16):
        lots = [order[a:b] for a, b in zip(starts[some : some + 16], [*starts[1:], len(order)][some : some + 16], strict=True)]
        columns = [pa.array([packed(codes[k], True) for k in lots], pa.binary()), *(pa.array([packed(m[k]) for k in lots], pa.binary()) for m in more)]
        yield pa.RecordBatch.from_arrays([pa.array(number[starts[some : some + 16]], pa.int32()), *columns], names)


def summed(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different codes in rising order, and the sums of their counts."""
    code, count = np.concatenate([np.zeros(0, np.int64), *codes]), np.concatenate([np.zeros(0, np.int64), *counts])
    order = np.argsort(code, kind="stable")
    code = code[order]
    first = np.flatnonzero(np.diff(code, prepend=-1))
    return code[first], np.add.reduceat(count[order], first) if len(first) else count


def _encoder(known: dict[bytes, int], head: int):
    """Numbers of words (-1 for unknown ones), and classes, of a slice of texts, each closed by its end."""

    def encode(texts: list[bytes | None]):
        split = [words(t) for t in texts]
        joined = [w for tokens in split for w in (*tokens, b"\n")]
        number = np.fromiter(map(known.get, joined, repeat(-1)), np.int64, len(joined))
        sizes = np.fromiter(map(len, split), np.int64, len(split)) + 1
        ends = np.cumsum(sizes) - 1
        dish = np.where((number >= 0) & (number < head), number, head + 1)
        dish[ends] = head
        context = np.empty_like(dish)
        context[1:] = dish[:-1]
        context[np.concatenate([[0], ends[:-1] + 1])] = head + 2
        return joined, number, dish, context, sizes, ends

    return encode


def class_pairs(texts: DataFrame, shared, head: int, buckets: int = 1) -> DataFrame:
    """``(bucket, code, c)``: pairs of a bucket as packed lists, how often each dish follows each context in the column ``text``."""
    ship()
    names = ["bucket", "code", "c"]

    def pairs(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder({w: k for k, w in enumerate(shared.value)}, head)
        codes, counts, size = [], [], 0
        for part in parts:
            for chunk in batches(part.column(0)):
                _, _, dish, context, _, _ = encode(chunk)
                found, n = np.unique(context * (head + 2) + dish, return_counts=True)
                codes.append(found)
                counts.append(n)
                size += len(found)
                if size > HELD_PAIRS:
                    found, n = summed(codes, counts)
                    codes, counts, size = [found], [n], len(found)
                    if size > HELD_PAIRS // 2:
                        yield from _by_bucket(found, buckets, names, n)
                        codes, counts, size = [], [], 0
        found, n = summed(codes, counts)
        yield from _by_bucket(found, buckets, names, n)
        del codes, counts, encode
        release()

    def merge(key: tuple[pa.Scalar, ...], lists: pa.Table) -> pa.Table:
        code, count = summed([unpacked(x, True) for x in lists.column("code").to_pylist()], [unpacked(x) for x in lists.column("c").to_pylist()])
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([packed(code, True)], pa.binary()), pa.array([packed(count)], pa.binary())], names)

    schema = "bucket int, code binary, c binary"
    return texts.select("text").mapInArrow(pairs, schema).groupBy("bucket").applyInArrow(merge, schema)


def discount_of(ones: int | None, twos: int | None) -> float:
    """The usual estimate from the numbers of things seen once and twice."""
    ones, twos = ones or 0, twos or 0
    return min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones and twos else 0.5


def _over(lists: DataFrame, run, schema: str) -> DataFrame:
    """The batches that ``run`` makes of each bucket: of its number and its unpacked columns, the first of them rising."""
    ship()

    def each(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for k in range(part.num_rows):
                row = part.slice(k, 1).to_pylist()[0]
                yield run(row.pop("bucket"), *[unpacked(x, at == 0) for at, x in enumerate(row.values())])
        release()

    return lists.mapInArrow(each, schema)


def _row(bucket: int, *columns: np.ndarray, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), *(pa.array([packed(x, at == 0)], pa.binary()) for at, x in enumerate(columns))], names)


def totals(lists: DataFrame, head: int, *columns: str) -> list[np.ndarray]:
    """Sums of packed columns by context, then by dish, as arrays of ``2 * head + 5``."""
    dishes, contexts = head + 2, head + 3

    def run(bucket: int, codes: np.ndarray, *values: np.ndarray) -> pa.RecordBatch:
        u, w = codes // dishes, codes % dishes
        number = np.concatenate([u, w + contexts])
        keys, at = np.unique(number, return_inverse=True)
        sums = [np.bincount(at, np.concatenate([v, v]), len(keys)).astype(np.int64) for v in values]
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *map(pa.array, sums)], ["k", *columns])

    flat = _over(lists.select("bucket", "code", *columns), run, "k long, " + ", ".join(f"{c} long" for c in columns))
    found = flat.groupBy("k").agg(*[F.sum(c).alias(c) for c in columns]).toArrow()
    out = []
    for c in columns:
        out.append(np.zeros(dishes + contexts, np.int64))
        out[-1][found.column("k").to_numpy()] = found.column(c).to_numpy()
    return out


def sample(pairs: DataFrame, head: int, burn: int = BURN, samples: int = SAMPLES, room: int = PAIRS) -> tuple[dict, DataFrame]:
    """What predictions need: weights of contexts and the parent in each sample, the most frequent pairs, and the table of all pairs.

    The table has rows ``(bucket, code, c, s)`` of packed lists; ``s`` is the sum of the numbers of tables over the samples.
    """
    context = pairs.sparkSession.sparkContext
    dishes, contexts = head + 2, head + 3
    names = ["bucket", "code", "c", "s"]
    schema = "bucket int, code binary, c binary, s binary"

    def lots(bucket, code, c):
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in np.unique(c, return_counts=True)], ["c", "n"])

    sizes = checkpointed(_over(pairs, lots, "c long, n long").groupBy("c").agg(F.sum("n").alias("n")))
    once, twice = sizes.agg(F.sum(F.when(F.col("c") == 1, F.col("n"))), F.sum(F.when(F.col("c") == 2, F.col("n")))).first()
    discount = discount_of(once, twice)
    running = sizes.withColumn("all", F.sum("n").over(Window.orderBy(F.desc("c"))))
    least = running.where(F.col("all") <= room).agg(F.min("c")).first()[0]

    singles = _over(pairs, lambda bucket, code, c: _row(bucket, code[c == 1], c[c == 1], samples * c[c == 1], names=names), schema)
    rows = _over(pairs, lambda bucket, code, c: _row(bucket, code[c > 1], c[c > 1], np.ones_like(code[c > 1]), 0 * code[c > 1], names=[*names[:3], "t", "s"]), "bucket int, code binary, c binary, t binary, s binary")
    alone = _over(pairs, lambda bucket, code, c: _row(bucket, code, c, (c == 1).astype(np.int64), names=[*names[:3], "o"]), "bucket int, code binary, c binary, o binary")
    customers, ones = totals(alone, head, "c", "o")
    rows = written(rows, "seating")
    (tables,) = totals(rows, head, "t")
    tables = tables + ones
    seating, parent = Seating(discount), Parent(dishes)
    parent.follow(tables[contexts:])
    kept_weight, kept_parent = [], []
    for number in range(burn + samples):
        shared = context.broadcast((seating, tables[:contexts], parent.predictive()))
        kept = number >= burn

        def sweep(bucket, code, c, t, s, shared=shared, number=number, kept=kept):
            seating, of, base = shared.value
            u, w = code // dishes, code % dishes
            new = seating.draw(c, (of[u] - t).astype(float), base[w], np.random.default_rng([SEED, number, bucket]).random(len(code)))
            return _row(bucket, code, c, new, s + new if kept else s, names=["bucket", "code", "c", "t", "s"])

        rows = written(_over(rows, sweep, "bucket int, code binary, c binary, t binary, s binary"), "seating")
        tables = totals(rows, head, "t")[0] + ones
        parent.follow(tables[contexts:])
        if kept:
            kept_weight.append((STRENGTH + discount * tables[:contexts]) / (STRENGTH + customers[:contexts]))
            kept_parent.append(parent.predictive())
    seen = written(rows.select(*names).unionByName(singles), "pairs")
    model = {"weight": np.array(kept_weight), "parent": np.array(kept_parent), "customers": customers[:contexts], "discount": discount, "samples": samples}

    def top(bucket, code, c, s):
        often = c >= least
        return pa.RecordBatch.from_arrays([pa.array(code[often], pa.int64()), pa.array(own(model, head, code[often], c[often], s[often]))], ["code", "own"])

    # ``room`` rows at most.
    found = _over(seen, top, "code long, own double").toArrow() if least is not None else pa.table({"code": pa.array([], pa.int64()), "own": pa.array([], pa.float64())})
    code, p = found.column("code").to_numpy(), found.column("own").to_numpy()
    order = np.argsort(code)
    return {**model, "code": code[order], "own": p[order]}, seen


def own(classes: dict, head: int, codes: np.ndarray, counts: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """What seen pairs get from their own restaurant."""
    return (counts - classes["discount"] * tables / classes["samples"]) / (STRENGTH + classes["customers"][codes // (head + 2)])


def back(classes: dict, head: int, codes: np.ndarray) -> np.ndarray:
    """What pairs get from the parent."""
    u, w = codes // (head + 2), codes % (head + 2)
    return sum(weight[u] * parent[w] for weight, parent in zip(classes["weight"], classes["parent"], strict=True)) / classes["samples"]


def fit(texts: DataFrame, head: int = HEAD, known: int = KNOWN, **options) -> tuple[dict, dict[str, DataFrame]]:
    """The model that is broadcast, and the tables of all words and of all pairs."""
    spark = texts.sparkSession
    counts = written(word_counts(texts), "word-counts")
    total, different = counts.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*")).first()
    ends = counts.where(F.col("word") == END).agg(F.max("count")).first()[0] or 0
    frequent = most_frequent(counts, known)
    head = min(head, len(frequent))
    names = [w.encode() for w, _ in frequent]
    buckets = 1 + int(total) // BUCKET_TOKENS
    pairs = written(class_pairs(texts, spark.sparkContext.broadcast(names[:head]), head, buckets), "class-pairs")
    model = {"names": names, "counts": np.array([c for _, c in frequent], np.int64), "head": head, "total": total, "different": different, "ends": ends}
    model["buckets"] = buckets
    model["classes"], seen = sample(pairs, head, **options)
    inside = int(model["counts"][:head].sum())
    model["other_total"], model["other_different"] = total - ends - inside, max(0, different - (ends > 0) - head)
    # The head's own counts are known; what is left of each number of words is that of the others.
    lots = Counter({r["count"]: r["n"] for r in counts.where(F.col("word") != END).groupBy("count").agg(F.count("*").alias("n")).collect()})
    lots.subtract(model["counts"][:head].tolist())
    model["pseudo"] = pseudo_count([(c, n) for c, n in lots.items() if n > 0])
    return model, {"words": counts, "pairs": seen}


#: What is kept of a scored text; ``pairs`` and ``times`` hold plain numbers of 8 and 4 bytes.
SCORED = "struct<n_tokens:bigint,score:double,base:double,known:bigint,pairs:binary,times:binary,rest:array<struct<word:string,n:bigint>>>"


def _cells(numbers: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A cell of bytes for each count, which holds so many of the numbers, one cell after the other."""
    offsets = np.concatenate([[0], np.cumsum(counts)]) * numbers.itemsize
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(numbers))])


def _numbers(cells: list[bytes], kind: str) -> np.ndarray:
    """The way back from ``_cells``, of some cells in a row."""
    return np.frombuffer(b"".join(cells), kind).astype(np.int64)


class Scorer:
    """Log10 probabilities of a slice of texts, but for the words and pairs that are not broadcast, as an array of ``kind``: ``SCORED``."""

    def __init__(self, model: dict, kind: pa.DataType):
        self.kind = kind
        self.head, self.classes = model["head"], model["classes"]
        self.encode = _encoder({w: k for k, w in enumerate(model["names"])}, self.head)
        self.code = self.classes["code"]
        self.seen = np.log10(self.classes["own"] + back(self.classes, self.head, self.code))
        self.floor = np.log10(model["total"] + model["different"] + 1)
        self.base = np.append(np.log10(model["counts"] + 1), np.log10(model["ends"] + 1)) - self.floor
        other = np.log10(model["counts"] + model["pseudo"]) - other_floor(model)
        other[: self.head] = 0
        self.other = np.append(other, 0)
        self.known_end = model["ends"] > 0

    def __call__(self, texts: list[bytes | None]) -> pa.Array:
        joined, number, dish, context, sizes, ends = self.encode(texts)
        of = np.repeat(np.arange(len(texts)), sizes)
        # Every pair once for each text that it is in, by rising code: sorted codes are found far faster.
        both = np.sort((context * (self.head + 2) + dish) * len(texts) + of)
        first = np.flatnonzero(np.diff(both, prepend=-1))
        times = np.diff(first, append=len(both))
        code, text = np.divmod(both[first], len(texts))
        at = np.minimum(np.searchsorted(self.code, code), max(0, len(self.code) - 1))
        here = self.code[at] == code if len(self.code) else np.zeros(len(code), bool)
        seen = np.bincount(text[here], times[here] * self.seen[at[here]], len(texts))
        number[ends] = len(self.other) - 1
        unknown = number < 0
        known = ~unknown
        if not self.known_end:
            known[ends] = False
        score, base, known = (np.add.reduceat(x, ends - sizes + 1) for x in (np.where(unknown, 0, self.other[number]), np.where(unknown, 0, self.base[number]), known.astype(np.int64)))
        code, text, times = code[~here], text[~here], times[~here]
        by_text = np.argsort(text, kind="stable")
        counts = np.bincount(text, minlength=len(texts))
        pairs = _cells(code[by_text].astype("<i8"), counts), _cells(times[by_text].astype("<i4"), counts)
        columns = [pa.array(sizes), pa.array(seen + score), pa.array(base), pa.array(known), *pairs, self._rest(joined, np.flatnonzero(unknown), of)]
        return pa.StructArray.from_arrays(columns, fields=list(self.kind))

    def _rest(self, joined: list[bytes], where: np.ndarray, of: np.ndarray) -> pa.Array:
        """The words at some places, those of each text with their number."""
        words: list[list[bytes]] = [[] for _ in range(int(of[-1]) + 1)]
        for i, t in zip(where.tolist(), of[where].tolist(), strict=True):
            words[t].append(joined[i])
        lots = [Counter(w) for w in words]
        kind = self.kind.field("rest").type
        flat = [pa.array([w.decode(errors="replace") for lot in lots for w in lot], pa.string()), pa.array([n for lot in lots for n in lot.values()], pa.int64())]
        offsets = np.concatenate([[0], np.cumsum([len(lot) for lot in lots])])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(flat, fields=list(kind.value_type)), type=kind)


def other_floor(model: dict) -> float:
    """Log10 of what the counts of the other words, with their pseudo counts and that of the unknown ones, add up to."""
    return float(np.log10(max(model["other_total"], 0) + model["pseudo"] * (model["other_different"] + 1)))


def _looked_up(scored: DataFrame, shared, pairs: DataFrame) -> DataFrame:
    """``(_row, more_pairs)``: log10 probabilities of the pairs of each document that are not broadcast."""

    def add(key: tuple[pa.Scalar, ...], lists: pa.Table) -> pa.Table:
        of = np.concatenate([unpacked(x, True) for x in lists.column("of").to_pylist()])
        found, at = np.unique(of, return_inverse=True)
        sums = np.bincount(at, np.concatenate([np.frombuffer(x, "<f8") for x in lists.column("p").to_pylist()]), len(found))
        return pa.table({"_row": pa.array(found), "more_pairs": pa.array(sums)})

    return _pair_sums(scored, shared, pairs).groupBy("lot").applyInArrow(add, "_row long, more_pairs double")


def _pair_sums(scored: DataFrame, shared, pairs: DataFrame) -> DataFrame:
    """``(lot, of, p)``: from each bucket, one list of documents and of the sums of their pairs in it for every lot of documents.

    A lot holds the documents, in a row, of ``HELD_PAIRS / 2`` pairs, or one of more; it has the number of its first document.
    """
    ship()
    names = ["bucket", "code", "n", "of"]

    def spread(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def drain() -> Iterator[pa.RecordBatch]:
            code, n, of = (np.concatenate(x) for x in zip(*held, strict=True))
            for lists in _by_bucket(code, shared.value["buckets"], names, n, of):
                yield lists.append_column("lot", pa.array(np.full(lists.num_rows, of[0])))

        for part in parts:
            row, (code, n) = part.column(0).to_numpy(), (part.column(k).to_pylist() for k in (1, 2))
            counts = np.fromiter(map(len, code), np.int64, len(code)) // 8
            start = 0
            while start < len(row):
                # As many rows as fill the lot, one at least.
                end = max(start + 1, int(np.searchsorted(np.cumsum(counts[start:]), HELD_PAIRS // 2 - size, "right")) + start)
                held.append((_numbers(code[start:end], "<i8"), _numbers(n[start:end], "<i4"), np.repeat(row[start:end], counts[start:end])))
                size += len(held[-1][0])
                if size and (end < len(row) or size >= HELD_PAIRS // 2):
                    yield from drain()
                    held, size = [], 0
                start = end
        if size:
            yield from drain()
        del held
        release()

    def look(wanted: pa.Table, known: pa.Table) -> pa.Table:
        head, classes = shared.value["head"], shared.value["classes"]
        lists = [[unpacked(x, k == 0) for k, x in enumerate(r)] for r in zip(*(known.column(c).to_pylist() for c in ("code", "c", "s")), strict=True)]
        rows, sums = [], []
        for code, n, of in zip(*(wanted.column(c).to_pylist() for c in names[1:]), strict=True):
            code, n, of = unpacked(code, True), unpacked(n), unpacked(of)
            p = back(classes, head, code)
            for have, c, s in lists:
                if len(have):
                    at = np.minimum(np.searchsorted(have, code), len(have) - 1)
                    hit = have[at] == code
                    p[hit] += own(classes, head, code[hit], c[at[hit]], s[at[hit]])
            found, at = np.unique(of, return_inverse=True)
            rows.append(packed(found, True))
            sums.append(np.bincount(at, n * np.log10(p), len(found)).astype("<f8").tobytes())
        del lists
        release()
        return pa.table([wanted.column("lot"), pa.array(rows, pa.binary()), pa.array(sums, pa.binary())], ["lot", "of", "p"])

    wanted = scored.select("_row", "_lm.pairs", "_lm.times").mapInArrow(spread, "bucket int, code binary, n binary, of binary, lot long")
    return wanted.groupBy("bucket").cogroup(pairs.groupBy("bucket")).applyInArrow(look, "lot long, of binary, p binary")


def apply(documents: DataFrame, model: dict, tables: dict[str, DataFrame], text: str = "text") -> DataFrame:
    """Documents without their text, with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``."""
    documents, now, restored = aside(documents, "_row", "_lm", "more", "more_base", "more_known", "more_pairs")
    text = now(text)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    kind = arrow_type(SCORED)

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(shared.value, kind)
        for texts in columns:
            yield pa.concat_arrays([pa.array([], kind), *map(scorer, batches(texts))])
        del scorer
        release()

    scored = documents.select("*", F.monotonically_increasing_id().alias("_row"), arrow_function(run, SCORED)(text).alias("_lm")).drop(text)
    scored = written(scored, "scored")
    floor, other = float(np.log10(model["total"] + model["different"] + 1)), other_floor(model)
    rest = scored.select("_row", F.inline("_lm.rest")).join(tables["words"], "word", "left").withColumn("c", F.coalesce("count", F.lit(0)))
    more = rest.groupBy("_row").agg(
        F.sum(F.col("n") * (F.log10(F.col("c") + model["pseudo"]) - other)).alias("more"),
        F.sum(F.col("n") * (F.log10(F.col("c") + 1) - floor)).alias("more_base"),
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more_known"),
    )
    joined = scored.join(more, "_row", "left").join(_looked_up(scored, shared, tables["pairs"]), "_row", "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    done = joined.withColumns(
        {
            "n_tokens": F.col("_lm.n_tokens"),
            "n_known": (F.col("_lm.known") + zero("more_known")).cast("bigint"),
            "train_tokens": F.lit(int(model["total"])).cast("bigint"),
            "base_score": F.col("_lm.base") + zero("more_base"),
            "score": F.col("_lm.score") + zero("more") + zero("more_pairs"),
        }
    ).drop("_row", "_lm", "more", "more_base", "more_known", "more_pairs")
    return restored(done)


def perplexity(score: str = "score", tokens: str = "n_tokens"):
    return F.pow(F.lit(10.0), -F.col(score) / F.col(tokens))


def op7(spark, sf_dir: str) -> DataFrame:
    """Log10 probability of every document, learned without the held-out ones."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model, tables = fit(documents.where(remainder("doc_id", HELD_OUT[0]) != HELD_OUT[1]))
    held = F.coalesce(remainder("doc_id", HELD_OUT[0]) == HELD_OUT[1], F.lit(False))
    return apply(documents, model, tables).select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
