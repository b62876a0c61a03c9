"""Read CIF text into DataFrames: files -> blocks -> records (one per category) -> typed rows.

Every reader takes a *source frame* ``(file_ord INT, path STRING, content)``; ``content`` is the raw bytes of
``binaryFile`` (plain or gzip) or, for text that Spark derived from tables, a string. All steps are narrow: a scan has
no shuffle, unused columns are never cut out of the row text (Catalyst prunes their expressions), and a filter on
``path`` moves below the parse.

``(file_ord, path, block_ord, row_id)`` is the order of the input.
"""

from __future__ import annotations

import gzip
import re
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cif_lake.functions import grammar as g
from cif_lake.operators.relational import stored
from cif_lake.sources import write
from cif_lake.sources.dictionary import Dictionary

KEYS = ("file_ord", "path", "block_ord", "block_name")
#: So many links of a dictionary are sent to the categories of all files; more meet them by a shuffle.
BROADCAST_LINKS = 100_000
#: Files that a task has read go on when they are so many bytes or files.
READ_BYTES, READ_FILES = 4 << 20, 1_000


def unroll(frame: DataFrame, keep: Sequence, array: Column | str, *names: str) -> DataFrame:
    """``posexplode`` (two names) or ``explode`` (one), empty arrays dropped.

    The outer form keeps the optimizer from deriving ``size(array) > 0``: it would push that test, and with it a second
    and third evaluation of the whole parse, below the stages that build the array.
    """
    make = F.posexplode_outer if len(names) == 2 else F.explode_outer
    return frame.select(*keep, make(array).alias(*names)).filter(F.col(names[-1]).isNotNull())


# --- input files ---------------------------------------------------------------------------------


def _glob_regex(pattern: str) -> str:
    """Regular expression for a glob in which ``**`` spans directories."""
    out, i = "", 0
    while i < len(pattern):
        if pattern.startswith("**/", i):
            out, i = out + "(?:.*/)?", i + 3
        elif pattern.startswith("**", i):
            out, i = out + ".*", i + 2
        elif pattern[i] in "*?":
            out, i = out + {"*": "[^/]*", "?": "[^/]"}[pattern[i]], i + 1
        else:
            out, i = out + re.escape(pattern[i]), i + 1
    return out + "$"


def _exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def _load(spark: SparkSession, pattern: str) -> DataFrame:
    reader = spark.read.format("binaryFile")
    if "**" in pattern:
        base = pattern[: pattern.index("**")]
        base = base[: base.rindex("/")] if "/" in base else "."
        name = pattern.rsplit("/", 1)[-1]
        if name != "**":
            reader = reader.option("pathGlobFilter", name)
        tree = reader.option("recursiveFileLookup", "true").load(base or "/")
        return tree.filter(F.col("path").rlike(_glob_regex(pattern)))
    if re.search(r"[\[\]{}]", pattern) and _exists(spark, pattern):
        # A literal name that holds glob characters.
        pattern = re.sub(r"([\[\]{}*?\\])", r"\\\1", pattern)
    return reader.load(pattern)


def source(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Source frame of a path, a glob or a list of both; the order and the duplicates of a list are kept."""
    patterns = [paths] if isinstance(paths, str) else list(paths)
    if not patterns:
        raise ValueError("no input files: the list of paths is empty")
    if any(p is None for p in patterns):
        raise ValueError("a path must not be NULL")
    frames = []
    for pattern in patterns:
        frame = _load(spark, pattern)
        if "**" in pattern and frame.select("path").isEmpty():
            raise ValueError(f"no files match {pattern}")
        frames.append(frame)
    return in_order(frames)


def in_order(frames: Sequence[DataFrame]) -> DataFrame:
    """One source frame of several, in list order; files of an earlier one come first."""
    parts = [f.select(F.lit(n).alias("file_ord"), "path", "content") for n, f in enumerate(frames)]
    return reduce(DataFrame.unionAll, parts)


def dealt_files(spark: SparkSession, directory: str, folders: int) -> DataFrame:
    """Source frame of the files that ``write.write_files`` dealt over ``folders`` below a directory, bytes as they are, empty files too.

    Each folder is listed and read by a task: Spark's own readers hold the status of every file in the driver.
    """
    named = write.qualified(spark, directory).rstrip("/")
    target_folder, temporary = write.uri(named), write.TEMPORARY

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, root = fs.FileSystem.from_uri(target_folder)
        packed = lambda paths, contents: pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(contents, pa.binary())], ["path", "content"])
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                paths, contents, held = [], [], 0
                for file in base.get_file_info(fs.FileSelector(f"{root}/{folder}", allow_not_found=True, recursive=True)):
                    if file.type != fs.FileType.File or temporary.search(file.path):
                        continue
                    # Its compression would be guessed from the name.
                    with base.open_input_stream(file.path, compression=None) as stream:
                        contents.append(stream.read())
                    paths.append(named + file.path.removeprefix(root))
                    held += len(contents[-1])
                    if held >= READ_BYTES or len(paths) >= READ_FILES:
                        yield packed(paths, contents)
                        paths, contents, held = [], [], 0
                if paths:
                    yield packed(paths, contents)

    found = spark.range(0, folders, 1, folders).mapInArrow(load, "path string, content binary")
    return found.select(F.lit(0).alias("file_ord"), "path", "content")


def several_files(spark: SparkSession, paths: str | Sequence[str]) -> bool:
    """Whether the patterns match more than one file, a file named twice counted twice; two names are looked at, at most."""
    patterns = [paths] if isinstance(paths, str) else list(paths)
    return len(patterns) > 1 or _load(spark, patterns[0]).select("path").limit(2).count() > 1


# Rows and not Arrow batches: these would hold the text of thousands of files at once.
@F.udf(T.BinaryType(), useArrow=False)
def _gunzip(content: bytes | None) -> bytes | None:
    return None if content is None else gzip.decompress(content)


def raw(src: DataFrame) -> DataFrame:
    """Plain bytes as ``content``. Gzip is told by its first two bytes; only gzip content visits Python."""
    if isinstance(src.schema["content"].dataType, T.StringType):
        return src.withColumn("content", F.col("content").cast("binary"))
    zipped = F.substring("content", 1, 2) == F.lit(b"\x1f\x8b")
    unzipped = _gunzip(F.when(zipped, F.col("content")))
    return src.withColumn("content", F.coalesce(unzipped, F.col("content")))


def text(src: DataFrame) -> DataFrame:
    """Replace ``content`` by ``text``."""
    if isinstance(src.schema["content"].dataType, T.StringType):
        return src.withColumnRenamed("content", "text")
    return raw(src).withColumn("text", F.col("content").cast("string")).drop("content")


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


# --- blocks --------------------------------------------------------------------------------------


def blocks(src: DataFrame, data_block: str | None = "*") -> DataFrame:
    """One row per data block: ``KEYS`` and its lexemes ``lex``.

    ``data_block``: ``"*"`` for all blocks, None for the first one, else a name (case-insensitive) that
    every file must hold exactly once. A file without a block header is one block without a name.
    """
    # Laid out in stages so that the lexemes and the block starts are computed once.
    lexed = text(src).selectExpr("file_ord", "path", f"{g.lexemes('text')} AS lex")
    placed = lexed.selectExpr("*", f"{g.block_starts('lex')} AS starts")
    placed = placed.selectExpr("*", f"transform(starts, p -> {g.header_name('element_at(lex, p)')}) AS names")
    if data_block is None:
        wanted = "array(0)"
    elif data_block == "*":
        wanted = "CASE WHEN size(starts) > 0 THEN sequence(0, size(starts) - 1) ELSE array(0) END"
    else:
        same = f"CASE WHEN lower(x) = {g.lit(data_block.lower())} THEN i END"
        wanted = f"filter(transform(names, (x, i) -> {same}), i -> i IS NOT NULL)"
    placed = placed.selectExpr("*", f"{wanted} AS wanted")
    if data_block not in (None, "*"):
        fault = "CASE WHEN size(wanted) = 0 THEN ' not present in ' ELSE ' is ambiguous in ' END"
        message = f"concat({g.lit(f"data block '{data_block}'")}, {fault}, path)"
        placed = placed.filter(f"CASE WHEN size(wanted) = 1 THEN true ELSE CAST(raise_error({message}) AS boolean) END")
    start, end = "coalesce(get(starts, n), 1)", "coalesce(get(starts, n + 1), size(lex) + 1)"
    one = f"named_struct('block_ord', n, 'block_name', get(names, n), 'lex', slice(lex, {start}, {end} - {start}))"
    return unroll(placed, ["file_ord", "path"], F.expr(f"transform(wanted, n -> {one})"), "b").select(
        "file_ord", "path", "b.block_ord", "b.block_name", "b.lex"
    )


def list_blocks(src: DataFrame) -> DataFrame:
    """Block names in file order: ``file_ord, path, block_ord, block_name``."""
    return blocks(src).filter(F.col("block_name").isNotNull()).select(*KEYS)


def split_blocks(src: DataFrame, partitions: int | None = None) -> DataFrame:
    """One row per block with its text: ``KEYS, text``; ``partitions`` spreads the blocks of large files over tasks."""
    out = blocks(src).select(*KEYS, F.array_join("lex", "").alias("text"))
    return out.repartition(partitions, "path", "block_ord") if partitions else out


# --- records -------------------------------------------------------------------------------------


def marks(frame: DataFrame) -> DataFrame:
    """Add ``marks``: the structural lexemes ``(p, k, n, has, cat, item)``, n lexemes up to the next one."""
    kind = f"CASE WHEN {g.may_be_structural('x')} THEN {g.kind('x', 'get(lex, i - 1)')} END"
    found = f"filter(transform(lex, (x, i) -> named_struct('p', i + 1, 'k', {kind})), m -> m.k IS NOT NULL)"
    frame = frame.selectExpr("*", f"{found} AS found0")
    width = "(coalesce(get(found0, j + 1).p, size(lex) + 1) - m.p - 1)"
    # Most values follow at once: the list is cut only where a comment comes first.
    has = f"({width} > 0 AND (NOT {g.is_comment('get(lex, m.p)')} OR exists(slice(lex, m.p + 1, {width}), x -> NOT {g.is_comment('x')})))"
    part = lambda n: f"CASE WHEN m.k = 'T' THEN {g.tag_part('element_at(lex, m.p)', n)} END"
    mark = f"named_struct('p', m.p, 'k', m.k, 'n', {width}, 'has', {has}, 'cat', {part(1)}, 'item', {part(2)})"
    return frame.selectExpr("*", f"transform(found0, (m, j) -> {mark}) AS marks").drop("found0")


#: Where the category changes from one mark to the next: the last tag of a record stands in front of the next such place.
CUTS = "filter(transform(marks, (m, i) -> CASE WHEN i = 0 OR NOT m.cat <=> get(marks, i - 1).cat THEN i + 1 END), c -> c IS NOT NULL)"


def tags_of(place: str) -> str:
    """How many tags a record has: SQL text. In a loop, the first tag with values behind it is the last one."""
    valued = f"array_position(transform(slice(marks, {place}.f, {place}.run), m -> m.has), true)"
    return f"CAST(CASE WHEN {place}.is_loop THEN coalesce(nullif({valued}, 0), {place}.run) ELSE {place}.run END AS int)"


def located(frame: DataFrame, categories: Sequence[str] | None, every: bool = False) -> DataFrame:
    """Add ``recs``: per category ``(category, is_loop, tags)``. The first record of a category counts, unless ``every``."""
    return recorded(marks(frame), categories, every)


def recorded(frame: DataFrame, categories: Sequence[str] | None, every: bool = False) -> DataFrame:
    """``recs`` as in ``located``, from the ``marks`` of a block."""
    frame = frame.selectExpr("*", "transform(marks, m -> lower(m.cat)) AS keys", f"{CUTS} AS cuts")
    if every:
        opens = "m.cat IS NOT NULL AND NOT coalesce(get(marks, i - 1).cat = m.cat, false)"
        at = f"filter(transform(marks, (m, i) -> CASE WHEN {opens} THEN i + 1 END), p -> p IS NOT NULL)"
    elif categories is None:
        at = "transform(array_distinct(filter(keys, k -> k IS NOT NULL)), c -> CAST(array_position(keys, c) AS int))"
    else:
        names = ", ".join(g.lit(c.lower()) for c in dict.fromkeys(categories))
        at = f"transform(filter(array({names}), c -> array_contains(keys, c)), c -> CAST(array_position(keys, c) AS int))"
    frame = frame.selectExpr("*", f"{at} AS at")
    # Places in ``marks`` only: steps over a list copy what its elements hold.
    run = "coalesce(get(filter(cuts, c -> c > f), 0), size(marks) + 1) - f"
    places = f"named_struct('f', f, 'is_loop', coalesce(get(marks, f - 2).k = 'L', false), 'run', {run})"
    frame = frame.selectExpr("*", f"transform(at, f -> {places}) AS places")
    record = f"named_struct('category', get(marks, t.f - 1).cat, 'is_loop', t.is_loop, 'tags', slice(marks, t.f, {tags_of('t')}))"
    return frame.selectExpr("*", f"transform(places, t -> {record}) AS recs").drop("keys", "cuts", "at", "places")


def headers(block_frame: DataFrame, categories: Sequence[str] | None = None) -> DataFrame:
    """One row per record without its data: ``KEYS, rec_ord, category, is_loop, items``."""
    found = located(block_frame, categories)
    return unroll(found, KEYS, "recs", "rec_ord", "r").select(
        *KEYS, "rec_ord", "r.category", "r.is_loop", F.col("r.tags.item").alias("items")
    )


def records(block_frame: DataFrame, categories: Sequence[str] | None = None, every: bool = False) -> DataFrame:
    """One row per record: ``KEYS, rec_ord, category, is_loop, items, has, rows``.

    ``rows`` holds the text of each row; ``has`` tells for each tag whether values follow it.
    """
    found = located(block_frame, categories, every)
    loop = "array(slice(lex, element_at(r.tags, -1).p + 1, element_at(r.tags, -1).n))"
    pairs = "transform(r.tags, t -> slice(lex, t.p + 1, t.n))"
    parts = f"CASE WHEN r.is_loop THEN {loop} ELSE {pairs} END"
    record = (
        "named_struct('category', r.category, 'is_loop', r.is_loop, 'items', transform(r.tags, t -> t.item), "
        f"'has', transform(r.tags, t -> t.has), 'parts', {parts})"
    )
    cut = unroll(found, KEYS, F.expr(f"transform(recs, r -> {record})"), "rec_ord", "r").select(
        *KEYS, "rec_ord", "r.category", "r.is_loop", "r.items", "r.has", "r.parts"
    )
    loop_rows = g.all_of(g.without_comments("get(parts, 0)"), g.row_pattern("size(items)"))
    # A key-value record is one row of its first values; a text field starts a line.
    first = f"coalesce(get({g.values(g.without_comments('part'))}, 0), '?')"
    gap = f"CASE WHEN {g.is_text_field('v')} THEN '\\n' ELSE ' ' END"
    pair_row = f"array(array_join(transform(transform(parts, part -> {first}), v -> concat({gap}, v)), ''))"
    return cut.selectExpr(*cut.columns, f"CASE WHEN is_loop THEN {loop_rows} ELSE {pair_row} END AS rows").drop("parts")


def row_counts(src: DataFrame, categories: Sequence[str] | None = None, data_block: str | None = "*") -> DataFrame:
    """Exact row count per record, no cell cut out: ``KEYS, category, n_rows``."""
    return records(blocks(src, data_block), categories).select(
        *KEYS, "category", F.size("rows").cast("bigint").alias("n_rows")
    )


def long_cells(
    src: DataFrame, categories: Sequence[str] | None = None, data_block: str | None = "*"
) -> DataFrame:
    """All cells of all categories in one pass: ``KEYS, category, row_id, pos, item, value``."""
    rows = unroll(records(blocks(src, data_block), categories), [*KEYS, "category", "items"], "rows", "row_id", "row")
    cells = F.expr("transform(items, (x, i) -> named_struct('item', x, 'raw', get(raw, i)))")
    keep = [*KEYS, F.lower("category").alias("category"), F.col("row_id").cast("bigint").alias("row_id")]
    cut = unroll(rows.selectExpr("*", f"{g.values('row')} AS raw"), keep, cells, "pos", "cell")
    return cut.select(*KEYS, "category", "row_id", "pos", "cell.item", "cell.raw").selectExpr(
        *KEYS, "category", "row_id", "pos", "item", f"{g.unquote('raw')} AS value"
    )


def tokenize(frame: DataFrame, column: str, *keys: str) -> DataFrame:
    """Tokens of a text column: ``keys, ord, value, is_null, quoted``; comments are skipped."""
    plain = g.values(g.without_comments(g.lexemes(column)))
    return unroll(frame, keys, F.expr(plain), "ord", "raw").selectExpr(
        *keys, "ord", f"{g.unquote('raw')} AS value", f"{g.is_null('raw')} AS is_null", f"{g.is_quoted('raw')} AS quoted"
    )


# --- scans ---------------------------------------------------------------------------------------


def present_items(src: DataFrame, category: str, data_block: str | None = None) -> list[str]:
    """Union of the items of a category over all files, first seen first; spelled as first seen."""
    seen = unroll(headers(blocks(src, data_block), [category]), ["file_ord", "path"], "items", "pos", "item")
    first = seen.groupBy(F.lower("item").alias("key")).agg(
        F.min(F.struct("file_ord", "path", "pos", "item")).alias("first")
    )
    # As many rows as the category has item names.
    return [r["first"]["item"] for r in sorted(first.collect(), key=lambda r: r["first"][:3])]


def schema_of(
    dictionary: Dictionary,
    category: str,
    column_source: str,
    present: Callable[[], list[str]],
    columns: Sequence[str] | None,
    filename: bool,
) -> tuple[list[str], list[str] | None]:
    """Items of a scan, and those allowed in a file (None: any); ``present`` lists the items of the files."""
    if column_source == "dictionary":
        known = dictionary.columns(category)
        if not known:
            raise ValueError(f"category '{category}' is not in the dictionary")
        items = known
    elif column_source == "files":
        known = None
        items = present()
        if not items:
            raise ValueError(f"category '{category}' is not present in any file")
    else:
        raise ValueError("column_source must be 'dictionary' or 'files'")
    if filename and "filename" in (i.lower() for i in items):
        raise ValueError(f"item 'filename' of '{category}' clashes with the provenance column")
    if columns is not None:
        spelled = {i.lower(): i for i in items}
        missing = [c for c in columns if c.lower() not in spelled]
        if missing:
            raise ValueError(f"no such items in '{category}': {missing}")
        items = [spelled[c.lower()] for c in columns]
    return items, known


def scan(
    src: DataFrame,
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
    """Scan one category of all files into typed columns.

    ``column_source="dictionary"`` gives every item the dictionary defines (sorted) and rejects files with other items;
    no file is opened to find the schema. ``"files"`` gives the union of the items present. ``columns`` narrows the
    result; ``filename`` and ``row_id`` (with the rest of the order key) are added on request.
    """
    dictionary = dictionary or Dictionary.seed(src.sparkSession)
    present = lambda: present_items(src, category, data_block)
    items, known = schema_of(dictionary, category, column_source, present, columns, filename)
    return typed_rows(
        records(blocks(src, data_block), [category]),
        category,
        items,
        dictionary,
        known=known,
        filename=filename,
        row_id=row_id,
        on_malformed=on_malformed,
    )


def allowed_only(recs: DataFrame, category: str, known: Sequence[str] | None) -> DataFrame:
    """Records with ``lower_items``, path and nothing but known items; any other stops the job."""
    if known is None:
        return recs
    allowed = ", ".join(g.lit(k.lower()) for k in known)
    unknown = f"array_except(lower_items, array({allowed}))"
    text_ = g.lit(f"items of '{category}' that are not in the dictionary: ")
    error = f"raise_error(concat({text_}, array_join({unknown}, ', '), ' in ', path))"
    return recs.filter(f"CASE WHEN size({unknown}) = 0 THEN true ELSE CAST({error} AS boolean) END")


def typed_rows(
    recs: DataFrame,
    category: str,
    items: Sequence[str],
    dictionary: Dictionary,
    *,
    known: Sequence[str] | None = None,
    filename: bool = True,
    row_id: bool = False,
    on_malformed: str = "error",
) -> DataFrame:
    """Rows of the records of one category as typed columns."""
    recs = recs.selectExpr("*", "transform(items, i -> lower(i)) AS lower_items")
    recs = allowed_only(recs, category, known)
    lead = ["file_ord", "path", "block_ord"]
    at = places_of(items)
    rows = unroll(recs.selectExpr(*lead, *at, "rows"), [*lead, *[f"at{n}" for n in range(len(at))]], "rows", "row_id", "row")
    return typed_cells(rows, category, items, dictionary, filename=filename, row_id=row_id, on_malformed=on_malformed)


def places_of(items: Sequence[str]) -> list[str]:
    """Columns ``at0``, ``at1``, ...: where the row of a record with ``lower_items`` has each item, -1 for nowhere."""
    return [f"CAST(array_position(lower_items, {g.lit(i.lower())}) AS int) - 1 AS at{n}" for n, i in enumerate(items)]


def typed_cells(
    rows: DataFrame,
    category: str,
    items: Sequence[str],
    dictionary: Dictionary,
    *,
    filename: bool = True,
    row_id: bool = False,
    on_malformed: str = "error",
) -> DataFrame:
    """Typed columns of row texts ``file_ord, path, block_ord, row_id, row`` with the ``places_of`` the items."""
    lead = ["file_ord", "path", "block_ord"]
    names = [f"at{n}" for n in range(len(items))]
    # One stage per step, so that no step is computed twice for one cell. The one-element unroll holds back filters on
    # columns: below it they would cut the row text once more for every column they name.
    keep = [*lead, "row_id"]
    tokens = unroll(rows, [*keep, *names], F.expr(f"array({g.values('row')})"), "tokens")
    raw_cells = tokens.selectExpr(*keep, *[f"get(tokens, {n}) AS c{i}" for i, n in enumerate(names)])
    values = raw_cells.selectExpr(*keep, *[f"{g.unquote(f'c{i}')} AS c{i}" for i in range(len(items))])
    out = []
    for i, item in enumerate(items):
        where = f"concat({g.lit(f'{category}.{item} of ')}, path)"
        out.append(f"{g.typed(f'c{i}', dictionary.item_type(category, item), where, on_malformed)} AS `{item}`")
    if row_id:
        out += ["file_ord", "block_ord", "CAST(row_id AS bigint) AS row_id"]
    if filename:
        out.append("path AS filename")
    return values.selectExpr(*out)


def scan_many(
    src: DataFrame,
    wanted: dict[str, Sequence[str]],
    dictionary: Dictionary | None = None,
    *,
    data_block: str | None = None,
    filename: bool = True,
    row_id: bool = False,
    on_malformed: str = "error",
) -> DataFrame:
    """Items of several categories in one pass over the text: the rows of all of them, each with its ``category``.

    There is one struct column for each category, by its name in ``wanted``; it is NULL in the rows of the others. Files with
    items that the dictionary does not define are rejected, as in ``scan``.
    """
    dictionary = dictionary or Dictionary.seed(src.sparkSession)
    recs = records(blocks(src, data_block), list(wanted)).selectExpr(
        "*", "lower(category) AS cat", "transform(items, i -> lower(i)) AS lower_items"
    )
    allowed, at = "CASE cat", "CASE cat"
    for category, items in wanted.items():
        known = dictionary.columns(category)
        missing = [i for i in items if i.lower() not in {k.lower() for k in known}]
        if not known or missing:
            raise ValueError(f"category '{category}' is not in the dictionary" if not known else f"no such items in '{category}': {missing}")
        key = g.lit(category.lower())
        allowed += f" WHEN {key} THEN array({', '.join(g.lit(k.lower()) for k in known)})"
        at += f" WHEN {key} THEN array({', '.join(f'CAST(array_position(lower_items, {g.lit(i.lower())}) AS int) - 1' for i in items)})"
    unknown = f"array_except(lower_items, {allowed} END)"
    error = f"raise_error(concat('items of ', category, ' that are not in the dictionary: ', array_join({unknown}, ', '), ' in ', path))"
    recs = recs.filter(f"CASE WHEN size({unknown}) = 0 THEN true ELSE CAST({error} AS boolean) END")
    lead = ["file_ord", "path", "block_ord", "cat"]
    rows = unroll(recs.selectExpr(*lead, f"{at} END AS at", "rows"), [*lead, "at"], "rows", "row_id", "row")
    # The one-element unroll keeps filters and repeated use above the cut of the row text, as in typed_rows.
    tokens = unroll(rows, [*lead, "row_id", "at"], F.expr(f"array({g.values('row')})"), "tokens")
    picked = tokens.selectExpr(*lead, "row_id", "transform(at, n -> get(tokens, n)) AS raw")
    values = unroll(picked, [*lead, "row_id"], F.expr(f"array(transform(raw, r -> {g.unquote('r')}))"), "v")
    out = ["cat AS category"]
    for category, items in wanted.items():
        cells = []
        for n, item in enumerate(items):
            where = f"concat({g.lit(f'{category}.{item} of ')}, path)"
            cells.append(f"{g.lit(item)}, {g.typed(f'get(v, {n})', dictionary.item_type(category, item), where, on_malformed)}")
        out.append(f"CASE WHEN cat = {g.lit(category.lower())} THEN named_struct({', '.join(cells)}) END AS `{category}`")
    if row_id:
        out += ["file_ord", "block_ord", "CAST(row_id AS bigint) AS row_id"]
    if filename:
        out.append("path AS filename")
    return values.selectExpr(*out)


def scan_apart(
    src: DataFrame, wanted: dict[str, Sequence[str]], dictionary: Dictionary | None = None, *, data_block: str | None = None, row_id: bool = False
) -> dict[str, DataFrame]:
    """``scan`` of several categories by one parse: a frame each of its items and ``filename``, read from one stored table.

    The parse of frames that only share their source is run once for each of them.
    """
    many = stored(scan_many(src, wanted, dictionary, data_block=data_block, row_id=row_id))
    lead = ["row_id"] if row_id else []
    return {
        c: many.filter(F.col("category") == c.lower()).select(*[F.col(f"`{c}`.`{i}`").alias(i) for i in items], *lead, "filename")
        for c, items in wanted.items()
    }


def file_list(src: DataFrame) -> DataFrame:
    """The files of a source, by ``filename``: those that hold none of a category too."""
    return src.select(F.col("path").alias("filename"))


def unknown_items(src: DataFrame, category: str, dictionary: Dictionary, data_block: str | None = None) -> DataFrame:
    """Items of a category that the dictionary does not define: ``path, item``. A scan would stop at them."""
    found = unroll(headers(blocks(src, data_block), [category]), ["path", "category"], "items", "pos", "item")
    known = dictionary.items.select(F.lower("item").alias("key"))
    key = F.lower(F.concat(F.lit("_"), "category", F.lit("."), "item"))
    return found.withColumn("key", key).join(known, "key", "left_anti").select("path", "item")


def scan_paths(spark: SparkSession, paths: str | Sequence[str], category: str, dictionary=None, **options) -> DataFrame:
    """Scan files; a ``filename`` column is added when more than one file matches."""
    options.setdefault("filename", several_files(spark, paths))
    return scan(source(spark, paths), category, dictionary, **options)


# --- listings ------------------------------------------------------------------------------------


def list_tables(src: DataFrame, dictionary: Dictionary, data_block: str | None = None) -> DataFrame:
    """Categories of a block with their documentation."""
    heads = headers(blocks(src, data_block)).select(
        "path", "rec_ord", F.col("category").alias("table_name"), F.size("items").cast("bigint").alias("column_count")
    )
    meta = dictionary.category_metadata.select(
        F.lower("category").alias("key"), "is_single_row", "description", F.col("groups").alias("category_groups"), "is_mandatory"
    )
    urls = dictionary.category_urls().select(F.lower("category").alias("ukey"), F.col("url").alias("comment"))
    return (
        heads.join(meta, F.lower("table_name") == F.col("key"), "left")
        .join(urls, F.lower("table_name") == F.col("ukey"), "left")
        .select(
            "path", "table_name", "comment", "column_count", "is_single_row", "description", "category_groups", "is_mandatory"
        )
    )


def list_columns(src: DataFrame, dictionary: Dictionary, data_block: str | None = None) -> DataFrame:
    """Items of a block: position from 1, documentation and type."""
    keep = ["path", F.col("category").alias("table_name")]
    cols = unroll(headers(blocks(src, data_block)), keep, "items", "pos", "column_name")
    key = F.lower(F.concat(F.lit("_"), F.col("table_name"), F.lit("."), F.col("column_name")))
    types = dictionary.items.select(F.lower("item").alias("key"), "dtype")
    urls = dictionary.item_urls().select(F.lower("item").alias("ukey"), F.col("url").alias("comment"))
    return (
        cols.withColumn("k", key)
        .join(types, F.col("k") == F.col("key"), "left")
        .join(urls, F.col("k") == F.col("ukey"), "left")
        .select(
            "path",
            "table_name",
            "column_name",
            (F.col("pos") + 1).cast("int").alias("column_index"),
            "comment",
            F.coalesce("dtype", F.lit("string")).alias("data_type"),
        )
    )


def list_relationships(src: DataFrame, dictionary: Dictionary, data_block: str | None = None) -> DataFrame:
    """Dictionary links whose two categories are both present in the block of a file."""
    found = headers(blocks(src, data_block)).select("path", F.lower("category").alias("cat"))
    # The categories of a path meet in one shuffle of one parse; their number of copies stays.
    held = found.filter("path IS NOT NULL").groupBy("path").agg(F.collect_list("cat").alias("cats"))
    present = held.select("path", "cats", F.explode("cats").alias("cat"))
    links = dictionary.links().select(
        "parent_table", "parent_column", "child_table", "child_column",
        F.lower("parent_table").alias("pk"), F.lower("child_table").alias("ck"),
    )
    # Spark would take the categories, lists from a few columns of numbers, for the smaller side: their size is the one that it guesses.
    few = links.limit(BROADCAST_LINKS + 1).count() <= BROADCAST_LINKS
    matched = present.join(F.broadcast(links) if few else links.hint("merge"), F.col("cat") == F.col("pk"))
    both = matched.filter(F.array_contains("cats", F.col("ck")))
    return both.select("path", *links.columns[:4])


def open_block(
    src: DataFrame, dictionary: Dictionary | None = None, data_block: str | None = None, *, views: str | None = None
) -> dict[str, DataFrame]:
    """Every category of a block as a DataFrame of the items present; ``views`` is a prefix for temp views.

    The records are persisted (spilling to disk), so reading several categories parses the text once; unpersist
    the frame under the key ``""`` when done.
    """
    dictionary = dictionary or Dictionary.seed(src.sparkSession)
    recs = records(blocks(src, data_block)).persist()
    keep = [F.lower("category").alias("key"), "category", "file_ord", "path", "rec_ord"]
    seen = unroll(recs, keep, "items", "pos", "item")
    first = (
        seen.groupBy("key", F.lower("item").alias("ikey"))
        .agg(F.min(F.struct("file_ord", "path", "rec_ord", "pos", "category", "item")).alias("f"))
        .collect()  # as many rows as there are items in the schema
    )
    schema: dict[str, list[str]] = {}
    for r in sorted(first, key=lambda r: r["f"][:4]):
        schema.setdefault(r["key"], []).append(r["f"]["item"])
    out = {"": recs}
    for key, items in schema.items():
        out[key] = typed_rows(recs.filter(F.lower("category") == key), key, items, dictionary, row_id=False, filename=False)
        if views is not None:
            out[key].createOrReplaceTempView(f"{views}{key}")
    return out
