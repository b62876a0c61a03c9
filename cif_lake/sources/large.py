"""Large files, each read by many tasks.

A file is cut at line ends into *pieces* of bounded size, next to the split of the file they come from. A piece cannot tell
alone whether it begins inside a text field or a quoted value, so it is looked at from every possible start state, and the
states are composed along the file. With its true state known, a piece is lexed by the grammar of ``read``; its structural
marks and value counts, added up along the file, say which record a run of values belongs to and at which column it
begins. A piece then cuts its own rows; only the rows that cross the end of a piece are shuffled.

``index`` writes tables below a folder: the pieces, what begins in them, the records (one row per block and category: items,
places, number of rows) and the row texts by category. Counts read the records; a scan reads the row texts of its category and
joins those that cross the end of a piece. The pieces are needed while the index is made only, and dropped then.

Bounds: a task holds one piece (one line, if that is longer); the piece states and the marks (not the values) of one file, and
the marks of one block, come together. A file on a compressed stream (``.gz``) has one split, but pieces as well.

Differences from ``read``: gzip is told by the name of the file. A field or quote that the end of the file leaves open lacks the
last line end. ``stop_`` or ``global_`` counts as a value when it opens a piece right behind a tag.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cif_lake.functions import grammar as g
from cif_lake.sources import read, write
from cif_lake.sources.dictionary import Dictionary

PIECE_BYTES = 1 << 20
#: What is known of so many pieces and marks in them is sent to the pieces; more meets them by a shuffle.
BROADCAST_PIECES = 200_000
#: What opens the value that a piece begins in, by start state; state 0 is between values.
OPENERS = ("", ";", "'''", '"""', "'", '"')

PIECE = ["path", "split", "piece"]


# --- start states ----------------------------------------------------------------------------------------------------

_OPENING = re.compile(rb"""(?:(?<=\s)|\A)['"#]|^;""", re.MULTILINE)
_CLOSING = [re.compile(p) for p in (b"", rb"\n;", rb"'''", rb'"""', rb"'(?=\s|\Z)", rb'"(?=\s|\Z)')]
_COMMENT = -1


def _closed(text: bytes, at: int, state: int) -> int:
    """Place behind the value that is open at ``at``; -1 if it stays open."""
    found = _CLOSING[state].search(text, at)
    return found.end() if found else -1


def _state_behind(text: bytes, at: int = 0) -> int:
    """State behind a text that is between values at ``at``; ``_COMMENT`` inside a comment."""
    while True:
        # A value may begin right behind another one that was closed.
        if text[at : at + 1] not in (b"'", b'"', b"#"):
            found = _OPENING.search(text, at)
            if found is None:
                return 0
            at = found.start()
        if text[at : at + 1] == b"#":
            at = text.find(b"\n", at)
            if at < 0:
                return _COMMENT
            continue
        state = next(s for s in (1, 2, 3, 4, 5) if text.startswith(OPENERS[s].encode(), at))
        at = _closed(text, at + len(OPENERS[state]), state)
        if at < 0:
            return state


def end_states(text: bytes) -> list[int]:
    """State behind a piece for each start state. Line ends close a comment, and pieces end there."""
    plain = max(_state_behind(text), 0)
    out = [plain]
    for state in range(1, len(OPENERS)):
        at = _closed(text, 0, state)
        if at < 0:
            out.append(state)
        elif text[at : at + 1].strip() == b"" and _state_behind(text[:at]) == 0:
            # The reading from state 0 is between values here too: both go on alike.
            out.append(plain)
        else:
            out.append(max(_state_behind(text, at), 0))
    return out


def _pieces(piece_bytes: int):
    """Arrow function: lines ``path, split, value`` -> pieces; each line with the line end in front of it."""
    types = pa.schema([("path", pa.string()), ("split", pa.int64()), ("piece", pa.int32()), ("content", pa.binary()), ("ends", pa.list_(pa.int32()))])

    def packed(path, split, piece, lines):
        text = b"".join(lines)
        columns = zip(types.types, ([path], [split], [piece], [text], [end_states(text)]), strict=True)
        return pa.RecordBatch.from_arrays([pa.array(v, t) for t, v in columns], schema=types)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, piece, lines, size = None, 0, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = batch.column("mark").to_numpy()
            starts = [0, *(np.flatnonzero(marks[1:] != marks[:-1]) + 1).tolist(), len(marks)]
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                here = (batch.column("path")[a].as_py(), batch.column("split")[a].as_py())
                if here != key:
                    if lines:
                        yield packed(*key, piece, lines)
                    key, piece, lines, size = here, 0, [], 0
                for line in batch.column("content").slice(a, b - a).to_pylist():
                    lines.append(b"\n" + line)
                    size += len(line) + 1
                    if size >= piece_bytes:
                        yield packed(*key, piece, lines)
                        piece, lines, size = piece + 1, [], 0
        if lines:
            yield packed(*key, piece, lines)

    return cut


def _along_file(states: pd.DataFrame) -> pd.DataFrame:
    """Start state of each piece of a file from the end states of those before it."""
    states = states.sort_values(["split", "piece"])
    start, state = [], 0
    for ends in states["ends"]:
        start.append(state)
        state = int(ends[state])
    return states[PIECE].assign(start=start)


# --- index -----------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Index:
    """Tables of an index: ``units`` (pieces and marks along the files), ``records``, ``parts`` (row texts)."""

    units: DataFrame
    records: DataFrame
    parts: DataFrame

    @staticmethod
    def load(spark: SparkSession, folder: str) -> Index:
        return Index(*(spark.read.parquet(f"{folder}/{name}") for name in ("units", "records", "parts")))


def _lexed(pieces: DataFrame) -> DataFrame:
    """Add ``lex`` to pieces with their start state; where that is not 0, the first lexeme ends an earlier value."""
    opener = f"get(array({', '.join(g.lit(o) for o in OPENERS)}), start)"
    opened = pieces.selectExpr("*", f"{opener} AS opener").selectExpr("*", "concat(opener, CAST(content AS string)) AS opened")
    return opened.selectExpr("*", f"{g.lexemes('opened')} AS lex").drop("opened", "content")


def _count(first: str, width: str) -> str:
    return f"CAST(size({g.values(g.without_comments(f'slice(lex, {first}, {width})'))}) AS bigint)"


def _units(lexed: DataFrame) -> DataFrame:
    """Pieces (kind P, ``ord`` 0) and their marks, each with the number of values behind it up to the next one."""
    lead = "IF(start = 0, 1, 2)"
    ahead = f"greatest(coalesce(get(marks, 0).p, size(lex) + 1) - {lead}, 0)"
    begin = f"named_struct('k', 'P', 'cat', CAST(NULL AS string), 'item', CAST(NULL AS string), 'name', CAST(NULL AS string), 'n', {_count(lead, ahead)})"
    name = f"CASE WHEN m.k = 'D' THEN {g.header_name('element_at(lex, m.p)')} END"
    mark = f"named_struct('k', m.k, 'cat', m.cat, 'item', m.item, 'name', {name}, 'n', {_count('m.p + 1', 'm.n')})"
    units = F.expr(f"concat(array({begin}), transform(marks, m -> {mark}))")
    rows = read.unroll(read.marks(lexed), [*PIECE, "start"], units, "ord", "u")
    along = Window.partitionBy("path").orderBy("split", "piece", "ord")
    real = (F.col("k") != "P").cast("long")
    placed = rows.select(*PIECE, "start", "ord", "u.*").select(
        "*", F.sum(real).over(along).alias("grp"), F.sum((F.col("k") == "D").cast("long")).over(along).alias("headers")
    )
    group = Window.partitionBy("path", "grp")
    before = group.orderBy("split", "piece", "ord").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select("*", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("carry"), F.sum("n").over(group).alias("n_values"))


def _records(units: DataFrame) -> DataFrame:
    """One row per block and category, the first record of a category, as in ``read``."""
    several = F.max("headers").over(Window.partitionBy("path"))
    marks = units.withColumn("last", several).filter("k <> 'P' AND (headers > 0 OR last = 0)")
    mark = F.expr("named_struct('p', grp, 'k', k, 'n', n_values, 'has', n_values > 0, 'cat', cat, 'item', item)")
    blocks = marks.groupBy("path", F.greatest(F.col("headers") - 1, F.lit(0)).cast("int").alias("block_ord")).agg(
        F.max("name").alias("block_name"), F.array_sort(F.collect_list(mark)).alias("marks")
    )
    keys = ["path", "block_ord", "block_name"]
    return read.unroll(read.recorded(blocks, None), keys, "recs", "rec_ord", "r").selectExpr(
        *keys, "rec_ord", "lower(r.category) AS key", "r.category", "r.is_loop", "r.tags.item AS items", "r.tags.has AS has", "r.tags.p AS groups",
        "CASE WHEN r.is_loop THEN CAST(ceil(element_at(r.tags, -1).n / size(r.tags)) AS bigint) ELSE 1L END AS n_rows",
    )


def index(spark: SparkSession, paths: str | Sequence[str], folder: str | None = None, piece_bytes: int = PIECE_BYTES) -> Index:
    """Index files below ``folder`` (default: a fresh one in the shared folder); ``Index.load`` finds it again."""
    folder = folder or write.work_folder(spark)
    lines = spark.read.option("lineSep", "\n").text([paths] if isinstance(paths, str) else list(paths))
    lines = lines.select(
        F.regexp_replace("_metadata.file_path", "^file:///", "file:/").alias("path"),
        F.col("_metadata.file_block_start").alias("split"),
        F.col("value").cast("binary").alias("content"),
    ).withColumn("mark", F.xxhash64("path", "split"))
    cut = lines.mapInArrow(_pieces(piece_bytes), "path string, split long, piece int, content binary, ends array<int>")
    write.save_table(cut, f"{folder}/pieces")
    pieces = spark.read.parquet(f"{folder}/pieces")
    starts = pieces.select(*PIECE, "ends").groupBy("path").applyInPandas(_along_file, "path string, split long, piece int, start int")
    write.save_table(_units(_lexed(_joined(pieces.drop("ends"), starts))), f"{folder}/units")
    units = spark.read.parquet(f"{folder}/units")
    _records(units).write.parquet(f"{folder}/records")
    write.save_table(_parts(pieces.drop("ends"), units, spark.read.parquet(f"{folder}/records")), f"{folder}/parts")
    write.drop_folder(spark, f"{folder}/pieces")
    return Index.load(spark, folder)


def _joined(pieces: DataFrame, places: DataFrame, size: str = "1") -> DataFrame:
    """Pieces with what is known of them; the texts stay where they are while the pieces are few enough for a broadcast."""
    few = (places.agg(F.sum(F.expr(size))).first()[0] or 0) <= BROADCAST_PIECES
    return pieces.join(F.broadcast(places) if few else places, PIECE)


# --- counts and scans --------------------------------------------------------------------------------------------------


def row_counts(found: Index) -> DataFrame:
    """Exact row count per block and category, from the index alone: ``path, block_ord, block_name, category, n_rows``."""
    return found.records.select("path", "block_ord", "block_name", "category", "n_rows")


def _chosen(found: Index, category: str, data_block: str | None) -> DataFrame:
    """Records of a category in the blocks asked for, as in ``read.blocks``."""
    recs = found.records.filter(F.col("key") == category.lower())
    if data_block == "*":
        return recs
    if data_block is None:
        return recs.filter("block_ord = 0")
    same = F.lower("name") == data_block.lower()
    held = found.units.groupBy("path").agg(F.count_if(same).alias("n"), F.max(F.when(same, F.col("headers") - 1)).cast("int").alias("block_ord"))
    fault = "CASE WHEN n = 0 THEN ' not present in ' ELSE ' is ambiguous in ' END"
    message = f"concat({g.lit(f"data block '{data_block}'")}, {fault}, path)"
    held = held.filter(f"CASE WHEN n = 1 THEN true ELSE CAST(raise_error({message}) AS boolean) END")
    return held.select("path", "block_ord").join(recs, ["path", "block_ord"])


def _parts(pieces: DataFrame, units: DataFrame, recs: DataFrame) -> DataFrame:
    """Row texts of the records, piece by piece: ``path, block_ord, key, is_loop, pos, split, piece, seq, row_id, edge, text``.

    A loop is one run as wide as the loop; a key-value record is one run of single values for each tag, ``pos``. ``edge`` marks the
    texts that may be a part of a row only.
    """
    loop = "array(named_struct('grp', element_at(groups, -1), 'pos', 0, 'width', size(items)))"
    pairs = "transform(groups, (x, i) -> named_struct('grp', x, 'pos', i, 'width', 1))"
    whose = ["block_ord", "key", "is_loop"]
    runs = recs.select("path", *whose, F.explode(F.expr(f"CASE WHEN is_loop THEN {loop} ELSE {pairs} END")).alias("r")).select("path", *whose, "r.*")
    want = F.struct("ord", F.when(F.col("ord") == 0, F.col("carry")).otherwise(0).alias("carry"), *whose, "pos", "width")
    wants = units.select(*PIECE, "start", "ord", "grp", "carry").join(runs, ["path", "grp"])
    wants = wants.groupBy(*PIECE, "start").agg(F.sort_array(F.collect_list(want)).alias("wants"))
    lexed = read.marks(_lexed(_joined(pieces, wants, "size(wants)")))
    # The run of a mark reaches to the next one; that of the piece itself begins behind the end of an earlier value.
    first = "IF(w.ord = 0, IF(start = 0, 1, 2), get(marks, w.ord - 1).p + 1)"
    width = f"greatest(coalesce(get(marks, w.ord).p, size(lex) + 1) - ({first}), 0)"
    rest = "CASE WHEN w.ord = 0 AND start > 0 THEN substring(element_at(lex, 1), length(opener) + 1) END"
    run = f"named_struct('w', w, 'rest', {rest}, 'lex', slice(lex, {first}, {width}), 'open', w.ord = size(marks), 'only', size(lex) = 1)"
    cut = read.unroll(lexed, PIECE, F.expr(f"transform(wants, w -> {run})"), "c").select(*PIECE, "c.w.*", "c.rest", "c.lex", "c.open", "c.only")
    # White space behind the end of an earlier value opens the next one, so that a ';' there is still seen not to be in column 1.
    bare = "trim(TRAILING concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13)) FROM rest)"
    cut = cut.selectExpr("*", f"CASE WHEN only THEN rest ELSE {bare} END AS ending")
    gap = "coalesce(substring(rest, length(ending) + 1), '')"
    cut = cut.selectExpr(
        *PIECE, *whose, "pos", "width", "carry", "open", "ending", f"concat({gap}, {g.without_comments('lex')}) AS body",
        "CAST(pmod(width - carry % width, width) AS int) AS lacking",
    ).selectExpr("*", f"CASE WHEN lacking > 0 THEN regexp_extract(body, {g.row_pattern('lacking')}, 0) ELSE '' END AS head")
    cut = cut.selectExpr("*", "substring(body, length(head) + 1) AS own").selectExpr("*", f"{g.all_of('own', g.row_pattern('width'))} AS rows")
    part = lambda seq, row, edge, text: f"named_struct('seq', {seq}, 'row_id', CAST({row} AS bigint), 'edge', {edge}, 'text', {text})"
    ending = f"CASE WHEN ending IS NULL THEN array() ELSE array({part('0', '(carry - 1) DIV width', 'true', 'ending')}) END"
    head = f"CASE WHEN head = '' THEN array() ELSE array({part('1', 'carry DIV width', 'true', 'head')}) END"
    own = f"transform(rows, (x, i) -> {part('2', '(carry + lacking) DIV width + i', 'open AND i = size(rows) - 1', 'x')})"
    keep = ["path", *whose, "pos", "split", "piece"]
    # Of a key-value record only the first value of each tag counts.
    return read.unroll(cut, keep, F.expr(f"concat({ending}, {head}, {own})"), "e").select(*keep, "e.*").filter("is_loop OR row_id = 0")


def _rows(found: Index, recs: DataFrame, category: str) -> DataFrame:
    """Row texts of the records of a category: ``path, block_ord, row_id, row``."""
    held = found.parts.filter(F.col("key") == category.lower())
    parts = held.filter("is_loop")
    row = ["path", "block_ord", "pos", "row_id"]
    glue = F.expr("array_join(transform(array_sort(collect_list(struct(split, piece, seq, text))), x -> x.text), '')")
    loops = parts.filter("NOT edge").select(*row, "text").unionByName(parts.filter("edge").groupBy(*row).agg(glue.alias("text")))
    # A key-value record is one row of its first values; a text field starts a line.
    cells = held.filter("NOT is_loop").groupBy(*row).agg(glue.alias("text"))
    cells = cells.groupBy("path", "block_ord").agg(F.map_from_entries(F.collect_list(F.struct("pos", "text"))).alias("cells"))
    first = f"coalesce(get({g.values('cells[i]')}, 0), '?')"
    gap = f"CASE WHEN {g.is_text_field('v')} THEN '\\n' ELSE ' ' END"
    pair = f"array_join(transform(transform(sequence(0, size(items) - 1), i -> {first}), v -> concat({gap}, v)), '')"
    pairs = recs.filter("NOT is_loop").select("path", "block_ord", "items").join(cells, ["path", "block_ord"], "left")
    return loops.selectExpr("path", "block_ord", "row_id", "text AS row").unionByName(pairs.selectExpr("path", "block_ord", "0L AS row_id", f"{pair} AS row"))


def scan(
    found: Index,
    category: str,
    dictionary: Dictionary | None = None,
    *,
    column_source: str = "dictionary",
    data_block: str | None = None,
    columns: Sequence[str] | None = None,
    filename: bool = True,
    row_id: bool = False,
    on_malformed: str = "error",
) -> DataFrame:
    """Typed rows of one category, as ``read.scan`` gives them; with ``row_id``, ``(path, block_ord, row_id)`` is their order."""
    dictionary = dictionary or Dictionary.seed(found.records.sparkSession)
    chosen = _chosen(found, category, data_block)

    def present() -> list[str]:
        seen = read.unroll(chosen, ["path"], "items", "pos", "item").groupBy(F.lower("item").alias("key"))
        first = seen.agg(F.min(F.struct("path", "pos", "item")).alias("first"))
        # As many rows as the category has item names.
        return [r["first"]["item"] for r in sorted(first.collect(), key=lambda r: r["first"][:2])]

    items, known = read.schema_of(dictionary, category, column_source, present, columns, filename)
    recs = read.allowed_only(chosen.selectExpr("*", "transform(items, i -> lower(i)) AS lower_items"), category, known)
    at = recs.selectExpr("path", "block_ord", *read.places_of(items))
    rows = _rows(found, recs, category).join(at, ["path", "block_ord"]).withColumn("file_ord", F.lit(0))
    return read.typed_cells(rows, category, items, dictionary, filename=filename, row_id=row_id, on_malformed=on_malformed)
