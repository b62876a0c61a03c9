"""Secret scans with corpus-wide ownership frequency.

A scan of each whole text finds assignments to secret names, access keys and long hexadecimal runs, and beyond them candidates: long
runs of token characters that look random. The 128-bit hash of each value is counted over the corpus by distinct owners and by
distinct repositories (texts, so that copies of a document count once, for the first owner). A credential belongs to one owner, and a
repository of it lies outside by mistake, at the rate ``LEAK``. A value is a widely copied example if that is refuted, at a level that
all values of the corpus share (``ALPHA``, so the bound grows with the logarithm of their number), in one of two ways: by the other
owners among its repositories (many owners with few copies each), or by the repositories outside its main owner where its owners are
as many as independent copies would have (few owners in all, each with many copies). So is one that at least ``OWNER_SHARE`` of all
owners (and ``EXAMPLE_OWNERS`` of them) and ``REPOSITORY_SHARE`` of all repositories have, copied texts included. Any other value that looks random is a live
credential, however often a few owners or texts repeat it. Candidates are reported only if they are live.

Only spans, hashes and counts are shuffled; a value that a third of the corpus copies is reduced before it meets others of its
kind, and its spans are joined by rows whose partitions Spark can split.

Defined results: a null or empty text has no spans; a null owner is one more owner; repeated rows count once as a repository and
each gets its spans. Result columns replace input columns of the same name.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cif_lake.llm.common import aside, checkpointed, table, text_function, written

# The base patterns, their least lengths, and the order of the kinds.
_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGN, LEAST_ACCESS = 6, 20
KINDS = ["assign", "access", "hex", "owned"]
_NAMES = [b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey"]

LEAST_TOKEN = 20
_TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
_TOKEN_BYTE = np.isin(np.arange(256), list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"))
#: Bits a character from which a value looks random, and the kinds of characters it must mix.
LIVE_BITS, LIVE_CLASSES = 3.0, 2
#: Repositories of a credential outside its owner, as a share; examples wrongly told, over all values of a corpus.
LEAK, ALPHA = 0.05, 0.01
#: Owners of an example, as a share of those that as many independent copies would have.
EVEN = 0.9
#: What is an example by its share of the corpus: least owners, share of all owners, share of all repositories.
EXAMPLE_OWNERS, OWNER_SHARE, REPOSITORY_SHARE = 3, 0.5, 0.001
MASK = "<secret>"

SPANS = "array<struct<start:int,end:int,kind:int,hash:string,random:boolean>>"


def looks_random(value: str) -> bool:
    counts = Counter(value).values()
    bits = -sum(c / len(value) * math.log2(c / len(value)) for c in counts)
    classes = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]"))
    return bits >= LIVE_BITS and classes >= LIVE_CLASSES and bool(re.search("[0-9]", value))


def scan(raw: bytes | None) -> list[dict]:
    """Base spans and candidates of a text, in code points, by start and kind."""
    if not raw:
        return []
    lower = raw.lower()
    named = any(name in lower for name in _NAMES)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], _TOKEN_BYTE[np.frombuffer(raw, np.uint8)].view(np.int8), [0]])))
    long = bool((edges[1::2] - edges[::2] >= LEAST_TOKEN).any())
    if not named and not long:
        return []
    text, found = raw.decode(errors="replace"), []

    def add(start: int, end: int, kind: int, value: str) -> None:
        digest = hashlib.blake2b(value.encode(), digest_size=16).hexdigest()
        found.append({"start": start, "end": end, "kind": kind, "hash": digest, "random": looks_random(value)})

    if named:
        for m in _ASSIGN.finditer(text):
            if len(m[2]) >= LEAST_ASSIGN:
                add(*m.span(), 0, m[2])
    if long:
        for m in _ACCESS.finditer(text):
            if len(m[0]) >= LEAST_ACCESS:
                add(*m.span(), 1, m[0])
        for m in _HEX.finditer(text):
            add(*m.span(), 2, m[0])
        taken = sorted((f["start"], f["end"]) for f in found)
        for m in _TOKEN.finditer(text):
            if looks_random(m[0]) and not any(b < m.end() and m.start() < e for b, e in taken):
                add(*m.span(), 3, m[0])
    return sorted(found, key=lambda f: (f["start"], f["kind"]))


def _named(owner: str) -> Column:
    return F.coalesce(F.col(owner).cast("string"), F.lit(""))


def ownership(found: DataFrame, owner: str = "_owner", repository: str = "_repository") -> DataFrame:
    """``(hash, owners, repositories, holders, most)`` of each value.

    Owners and repositories are distinct; each repository is held by the first of its owners: ``holders`` counts those, ``most`` is the
    largest number of repositories that one of them holds.
    """
    values = found.select(F.explode("_spans.hash").alias("hash"), _named(owner).alias("o"), F.col(repository).alias("r"))
    owners = values.groupBy("hash", "o").agg(F.lit(1).alias("one")).groupBy("hash").agg(F.count("*").alias("owners"))
    held = values.groupBy("hash", "r").agg(F.min("o").alias("o")).groupBy("hash", "o").agg(F.count("*").alias("n"))
    held = held.groupBy("hash").agg(F.sum("n").alias("repositories"), F.count("*").alias("holders"), F.max("n").alias("most"))
    return owners.join(held, "hash")


def owner_classes(found: DataFrame, owner: str = "_owner", repository: str = "_repository") -> list[tuple[int, float]]:
    """Owners by size, in powers of two: how many there are, and the mean share of all repositories that one has."""
    sizes = found.select(_named(owner).alias("o"), F.col(repository).alias("r")).distinct().groupBy("o").agg(F.count("*").alias("n"))
    # At most 63 classes.
    classes = sizes.groupBy(F.floor(F.log2("n")).alias("c")).agg(F.count("*").alias("owners"), F.sum("n").alias("n")).orderBy("c").collect()
    total = sum(c["n"] for c in classes)
    return [(c["owners"], c["n"] / c["owners"] / total) for c in classes]


def evidence(outside: Column, repositories: Column, leak: float = LEAK) -> Column:
    """Chernoff bound, as a negative logarithm, of the chance that so many of the repositories or more lie outside."""
    share = outside / repositories
    inside = F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - leak))).otherwise(0.0)
    return F.when(share > leak, repositories * (share * F.log(share / leak) + inside)).otherwise(0.0)


def copied(values: DataFrame, classes: list[tuple[int, float]], leak: float = LEAK, alpha: float = ALPHA, even: float = EVEN) -> DataFrame:
    """``ownership`` with ``example``: whether a value is a widely copied example."""
    bound = math.log(max(values.count(), 1) / alpha)
    n = F.col("repositories")
    expected = sum((F.lit(owners) * (1 - F.pow(F.lit(1 - share), n)) for owners, share in classes), F.lit(0.0))
    wide = evidence(F.col("holders") - 1, n, leak) >= bound
    spread = (evidence(n - F.col("most"), n, leak) >= bound) & (F.col("holders") >= even * expected)
    return values.withColumn("example", wide | spread)


def judged(found: DataFrame) -> DataFrame:
    """``(_row, spans)``: the base spans and the live candidates of each row that has any, each with ``verdict`` live, example or weak."""
    classes = owner_classes(found)
    all_owners, all_repositories = sum(n for n, _ in classes), found.select("_repository").distinct().count()
    usual = (F.col("owners") >= max(EXAMPLE_OWNERS, OWNER_SHARE * all_owners)) & (F.col("repositories") >= REPOSITORY_SHARE * all_repositories)
    values = copied(checkpointed(ownership(found)), classes).withColumn("example", F.col("example") | usual).drop("holders", "most")
    spans = found.select("_row", F.inline("_spans")).join(values, "hash")
    verdict = F.when(F.col("example"), "example").when(F.col("random"), "live").otherwise("weak")
    kept = spans.withColumn("verdict", verdict).where((F.col("kind") < 3) | (F.col("verdict") == "live"))
    one = F.struct("start", "kind", "end", "verdict", "owners", "repositories")
    return kept.groupBy("_row").agg(F.array_sort(F.collect_list(one)).alias("spans"))


def scanned(documents: DataFrame, owner: str, text: str) -> DataFrame:
    function = text_function(lambda: lambda texts: [scan(t) for t in texts], SPANS)
    return documents.select("*", F.monotonically_increasing_id().alias("_row"), F.col(owner).alias("_owner"), F.xxhash64(text).alias("_repository"), function(text).alias("_spans"))


def find(documents: DataFrame, owner: str = "source", text: str = "text", name: str = "spans") -> DataFrame:
    """Documents without their text, with the array ``spans`` of ``(start, kind, end, verdict, owners, repositories)``."""
    documents, now, back = aside(documents, "_row", "_owner", "_repository", "_spans")
    found = checkpointed(scanned(documents, now(owner), now(text)).drop(now(text)))
    spans = judged(found).withColumnRenamed("spans", name)
    return back(found.drop("_owner", "_repository", "_spans", name).join(spans, "_row", "left").withColumn(name, F.coalesce(name, F.array())).drop("_row"))


def redact(documents: DataFrame, owner: str = "source", text: str = "text", mask: str = MASK) -> DataFrame:
    """All documents, with spans that aren't widely copied examples replaced by a mask; overlapping spans become one mask.

    Only the texts that have spans are shuffled.
    """
    columns = documents.columns
    packed = documents.select(F.struct("*").alias("_d"), F.col(owner).alias("_o"), F.col(text).alias("_t"))
    kept = written(scanned(packed, "_o", "_t").drop("_o", "_t"), "secrets")
    hidden = F.filter("spans", lambda s: s["verdict"] != "example")
    cuts = judged(kept).select("_row", F.transform(hidden, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("cuts"))
    plain = kept.where(F.size("_spans") == 0).select("_d")
    changed = kept.where(F.size("_spans") > 0).join(cuts, "_row", "left")
    # Between the cuts, in order: the text from the furthest end so far to the start of the next one that begins behind it.
    state = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))

    def step(a, c):
        piece = F.substring(F.col(f"_d.`{text}`"), a["at"] + 1, F.greatest(c["start"] - a["at"], F.lit(0)))
        fresh = F.when(c["start"] >= a["at"], F.concat(a["done"], piece, F.lit(mask))).otherwise(a["done"])
        return F.struct(fresh.alias("done"), F.greatest(a["at"], c["end"]).alias("at"))

    folded = F.aggregate("cuts", state, step)
    rest = F.concat(folded["done"], F.substring(F.col(f"_d.`{text}`"), folded["at"] + 1, F.lit(2**31 - 1)))
    changed = changed.select(F.col("_d").withField(f"`{text}`", F.when(F.size("cuts") > 0, rest).otherwise(F.col(f"_d.`{text}`"))).alias("_d"))
    return plain.unionByName(changed).select(*(F.col(f"_d.`{c}`").alias(c) for c in columns))


def digest(spans, only_base: bool = False):
    """``kind:start:end`` of the spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    chosen = F.filter(spans, lambda s: s["kind"] < 3) if only_base else F.col(spans)
    return F.concat_ws(",", F.transform(chosen, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))))


def op9(spark, sf_dir: str) -> DataFrame:
    """Spans of every document."""
    found = find(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    live = F.size(F.filter("spans", lambda s: s["verdict"] == "live")).cast("bigint")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(digest("spans", True).cast("binary"), 256).alias("base_sha256"),
        digest("spans").alias("spans"),
        live.alias("n_live"),
    )
