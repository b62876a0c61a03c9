"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target in words: its weight's share of all words, at most ``copies`` times what it has; what is over goes to the
other sources by their weights, until none is above its limit. A document of a source that has r times its words as target is
expected r times (with a preference: in proportion to it, ``copies`` times at most). The whole part of that is certain. One more copy
goes to a sample: documents are ranked by the odds of a uniform draw divided by the odds of their inclusion probability, and the
first of them are taken.

Samples are drawn for each source and class of sizes (an eighth of an octave wide), a fixed number of documents from each. Numbers are
rounded from the class of the largest documents to that of the smallest, and the words that rounding leaves over or takes too many
are carried to the next class. So a source ends near its target, however few or uneven its documents are.

Ranks are never taken over a whole class: draws are counted in buckets of a few hundred documents, and only the bucket that the
sample ends in is ordered. Of a document only its id, source, size and hash are written and shuffled; the driver sees sums only. Draws
depend on id, text and number among equal rows, so they are the same in every run and for every partitioning.

Defined results: a null text has size 0, and nothing is taken from it; a null source is a source of its own, the last one; rows equal in
id, source and text are told apart by a number; a source without words has target 0; no rows give none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cif_lake.llm.common import checkpointed, shared_folder, table, written
from cif_lake.operators.relational import numbered

WEIGHTS, COPIES = (5.0, 2.0, 1.0), 3
WORD = r"[^\x20\x09-\x0D]+"
#: Documents of a bucket of draws, and the rows up to which a table of sources or classes is broadcast.
BUCKET_ROWS, BROADCAST_ROWS = 512, 100_000
#: Expected copies nearer than this to a whole number are that number.
NEAR = 1e-9


def records(documents: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", preference: str | None = None) -> DataFrame:
    """``(doc_id, source, size, preference, hash, copy)``: one row for each document, equal ones numbered by ``copy``."""
    col = lambda name: F.col(f"`{name}`")
    size = F.coalesce(F.regexp_count(col(text), F.lit(WORD)), F.lit(0)).cast("bigint")
    liked = F.lit(1.0) if preference is None else F.greatest(F.coalesce(F.nanvl(col(preference).cast("double"), F.lit(0.0)), F.lit(0.0)), F.lit(0.0))
    keys = ["doc_id", "source", "size", "preference", "hash"]
    rows = documents.select(col(doc_id).alias("doc_id"), col(source).alias("source"), size.alias("size"), liked.alias("preference"), F.xxhash64(col(text)).alias("hash"))
    counted = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    return counted.select(*keys, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("copy"))


def targets(rows: DataFrame, weights: Sequence[float] = WEIGHTS, copies: int = COPIES, share: float = 1.0) -> DataFrame:
    """``(number, source, source_size, target)`` for each source of ``(source, size)``, numbered from 1 in the order of code points."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = numbered(sizes, F.col("source").asc_nulls_last(), name="number")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("number") - 1) % len(weights) + 1).cast("int"))
    found = checkpointed(ordered.select("number", "source", "source_size", weight.alias("weight"), (F.col("source_size") * F.lit(float(copies))).alias("most")))
    total = share * (found.agg(F.sum("source_size")).first()[0] or 0)
    level, before = 0.0, -1
    capped = F.lit(False)
    while True:
        full, open_weight, n = found.agg(F.sum(F.when(capped, F.col("most"))), F.sum(F.when(~capped, F.col("weight"))), F.count_if(capped)).first()
        if n == before or not open_weight:
            break
        level, before = (total - (full or 0.0)) / open_weight, n
        capped = F.col("most") < F.col("weight") * F.lit(level)
    goal = F.when(capped, F.col("most")).otherwise(F.col("weight") * F.lit(level))
    return found.select("number", "source", "source_size", F.least(goal, F.col("most")).alias("target"))


def _with(left: DataFrame, right: DataFrame, on: Column | list[str], how: str = "inner") -> DataFrame:
    """Join with a table of sources or classes: broadcast if it is small, which is counted first."""
    small = right.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return left.join(F.broadcast(right) if small else right, on, how)


def _factors(placed: DataFrame, copies: int) -> DataFrame:
    """``(number, factor)``: what the preference of a source's documents is multiplied with to give the copies expected of each."""
    liked = F.col("preference") * F.col("size")
    factors = checkpointed(placed.groupBy("number", "target").agg(F.sum(liked).alias("open")).select("number", (F.col("target") / F.col("open")).alias("factor"), F.lit(0).cast("bigint").alias("n")))
    while True:
        full = F.col("factor") * F.col("preference") >= copies
        # As many rows as there are sources.
        parts = _with(placed, factors, ["number"]).groupBy("number", "target", "n", "factor").agg(F.coalesce(F.sum(F.when(~full, liked)), F.lit(0.0)).alias("open"), F.coalesce(F.sum(F.when(full, F.col("size"))), F.lit(0)).alias("held"), F.count_if(full).alias("now"))
        parts = checkpointed(parts)
        if parts.where("now > n").isEmpty():
            return factors.drop("n")
        better = F.when(F.col("open") > 0, (F.col("target") - copies * F.col("held")) / F.col("open")).otherwise(F.col("factor"))
        factors = parts.select("number", better.alias("factor"), F.col("now").alias("n"))


def _draws() -> Column:
    bits = F.xxhash64("doc_id", "hash", "copy", F.lit("mix")).bitwiseAND(F.lit((1 << 52) - 1))
    return (bits + F.lit(0.5)) / F.lit(float(1 << 52))


#: Sizes with the same highest four bits.
_CLASS = "CAST(length(bin(size)) * 16 + shiftright(size, greatest(length(bin(size)) - 4, 0)) AS int)"


def _sample_sizes(expected: DataFrame) -> DataFrame:
    """``(number, class, members, chance, n)``: how many documents of a class are drawn; words are carried from class to class."""
    strata = expected.where("chance > 0").groupBy("number", "class").agg(F.count("*").alias("members"), F.sum("chance").alias("chance"), F.sum(F.col("chance") * F.col("size")).alias("words"))
    # At most a few hundred classes of a source.
    listed = strata.groupBy("number").agg(F.sort_array(F.collect_list(F.struct("class", "members", "chance", "words")), asc=False).alias("classes"))
    mean = "(c.words / c.chance)"
    n = f"least(c.members, greatest(0, CAST(round((acc.carry + c.words) / {mean}) AS bigint)))"
    step = f"named_struct('carry', acc.carry + c.words - {n} * {mean}, 'out', concat(acc.out, array(named_struct('class', c.class, 'members', c.members, 'chance', c.chance, 'n', {n}))))"
    empty = "CAST(array() AS array<struct<class:int,members:bigint,chance:double,n:bigint>>)"
    dealt = f"aggregate(classes, named_struct('carry', CAST(0 AS double), 'out', {empty}), (acc, c) -> {step}, acc -> acc.out)"
    return listed.select("number", F.expr(f"inline({dealt})"))


def _ranked(expected: DataFrame, sizes: DataFrame) -> DataFrame:
    """Documents of classes of which some, not all, are drawn, with their Pareto rank variable ``q`` and its bucket."""
    some = sizes.where("n > 0 AND n < members")
    joined = _with(expected.where("chance > 0"), some.withColumnRenamed("chance", "chances"), ["number", "class"])
    odds = lambda p: p / (1 - p)
    scaled = F.least(F.col("chance") * F.col("n") / F.col("chances"), F.lit(1 - NEAR))
    ranked = joined.withColumn("q", odds(F.col("draw")) / odds(scaled))
    # As the draws are uniform where all chances are equal, so is this.
    level = F.col("q") * F.col("n") / (F.col("members") - F.col("n"))
    buckets = F.ceil(F.col("members") / BUCKET_ROWS)
    return ranked.withColumn("bucket", F.least(F.floor(level / (1 + level) * buckets), buckets - 1))


def sample(expected: DataFrame) -> DataFrame:
    """``(number, class, members, n, last)`` of ``(number, class, size, chance, draw, ...)``: the documents up to ``last`` are drawn.

    ``last`` is the greatest ``(q, key)`` of a drawn document; null where all or none of a class are.
    """
    sizes = checkpointed(_sample_sizes(expected))
    ranked = _ranked(expected, sizes)
    counts = ranked.groupBy("number", "class", "n", "bucket").agg(F.count("*").alias("held"))
    ahead = Window.partitionBy("number", "class").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.withColumn("before", F.coalesce(F.sum("held").over(ahead), F.lit(0)))
    ends = checkpointed(before.where("before < n AND n <= before + held").select("number", "class", "bucket", (F.col("n") - F.col("before")).alias("need")))
    inside = _with(ranked.select("number", "class", "bucket", F.struct("q", "key").alias("place")), ends, ["number", "class", "bucket"])
    order = Window.partitionBy("number", "class").orderBy("place")
    last = inside.withColumn("at", F.row_number().over(order)).where("at = need").select("number", "class", F.col("place").alias("last"))
    return checkpointed(sizes.join(last, ["number", "class"], "left"))


def mix(documents: DataFrame, weights: Sequence[float] = WEIGHTS, copies: int = COPIES, share: float = 1.0, doc_id: str = "doc_id", source: str = "source", text: str = "text", preference: str | None = None) -> DataFrame:
    """``(doc_id, source, hash, size, source_size, target, copies, taken)`` for every row; ``hash`` is that of the text.

    ``weights`` are dealt to the sources in the order of their code points, again and again. ``share`` is the mix's size in words
    relative to all. ``preference`` names a column of documents that are wanted more often than others of their source; a value that
    is null, NaN or negative counts as 0.
    """
    shared_folder(documents.sparkSession)
    rows = written(records(documents, doc_id, source, text, preference), "mix")
    goals = targets(rows, weights, copies, share).withColumnRenamed("source", "name")
    placed = _with(rows, goals, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    if preference is None:
        times = F.col("target") / F.col("source_size")
    else:
        placed = _with(placed, _factors(placed.where("size > 0"), copies), ["number"], "left")
        times = F.least(F.col("factor") * F.col("preference"), F.lit(float(copies)))
    times = F.when(F.col("size") > 0, F.coalesce(times, F.lit(0.0))).otherwise(0.0)
    times = F.when(F.abs(times - F.round(times)) < NEAR, F.round(times)).otherwise(times)
    key = F.xxhash64("doc_id", "hash", "copy", F.lit("tie"))
    expected = placed.withColumns({"times": times, "class": F.expr(_CLASS), "draw": _draws(), "key": key})
    expected = expected.withColumns({"whole": F.floor("times").cast("bigint"), "chance": F.col("times") - F.floor("times")})
    limits = sample(expected).select("number", "class", F.col("chance").alias("chances"), "members", "n", "last")
    joined = _with(expected, limits, ["number", "class"], "left")
    scaled = F.least(F.col("chance") * F.col("n") / F.col("chances"), F.lit(1 - NEAR))
    q = (F.col("draw") / (1 - F.col("draw"))) / (scaled / (1 - scaled))
    drawn = F.when(F.col("n") == 0, False).when(F.col("n") == F.col("members"), True).otherwise(F.struct(q.alias("q"), "key") <= F.col("last"))
    extra = F.when((F.col("chance") > 0) & F.coalesce(drawn, F.lit(False)), 1).otherwise(0)
    took = joined.withColumn("copies", F.col("whole") + extra)
    return took.select("doc_id", "source", "hash", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def repeated(documents: DataFrame, decisions: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The documents of the mix, each as often as ``mix`` decided; rows equal in id, source and text are one document, the first of them."""
    columns = documents.columns
    keys = ["_1", "_2", "_3"]
    packed = documents.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(f"`{doc_id}`").alias("_1"), F.col(f"`{source}`").alias("_2"), F.xxhash64(F.col(f"`{text}`")).alias("_3")).dropDuplicates(keys)
    wanted = decisions.groupBy(F.col("doc_id").alias("w1"), F.col("source").alias("w2"), F.col("hash").alias("w3")).agg(F.sum("copies").alias("times")).where("times > 0")
    same = F.col("_1").eqNullSafe(F.col("w1")) & F.col("_2").eqNullSafe(F.col("w2")) & (F.col("_3") == F.col("w3"))
    out = packed.join(wanted, same).select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), "times")))
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in columns])


def op11(spark, sf_dir: str) -> DataFrame:
    """What the mix of all documents takes from each."""
    taken = mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return taken.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")
