"""CIF text of values, rows and categories, as column expressions and grouped aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cif_lake.functions.grammar import lit

# Fixed values of the format: characters that need quotes, and first characters and words a bare value must not start with.
_WIDE = "[ \t\r\x0b\x0c'\"]"
_SPECIAL_FIRST = r"^[$#_;()\[\]{}]"
_RESERVED = r"(?i)^(?:data_|loop_|save_|stop_|global_)"
_NEEDS_QUOTES = f"{_WIDE}|{_SPECIAL_FIRST}|{_RESERVED}|^[.?]\\z"


def needs_text_field(value: str) -> str:
    """Values that only a text field can hold: more than one line, or both kinds of quotes."""
    return f"(contains({value}, '\\n') OR (contains({value}, '\\'') AND contains({value}, '\"')))"


def unwritable(value: str) -> str:
    """Values no CIF text can hold: they need a text field and a line of theirs starts with ``;`` (or the end would be lost)."""
    bad = f"(startswith({value}, ';') OR contains({value}, '\\n;') OR endswith({value}, '\\r'))"
    return f"({needs_text_field(value)} AND {bad})"


def unwritable_values(frame: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Find them before writing: ``keys, item, value``."""
    cells = F.array(*[F.struct(F.lit(c).alias("item"), F.col(c).cast("string").alias("value")) for c in columns])
    return frame.select(*keys, F.explode(cells).alias("c")).select(*keys, "c.*").filter(unwritable("value"))


def value(value: str, item: str = "value", eol: str = "'\\n'", item_text: str | None = None) -> str:
    """Text of one value with the least quoting that reads back the same; a text field starts in column 1.

    ``item_text`` is SQL text that gives the item's name instead of ``item``. NULL and empty text are ``?``; text that reads ``.`` or ``?`` is quoted. Unwritable text stops the job.
    """
    v = value
    name = item_text or lit(item)
    message = f"""'cannot write value of \\'', {name}, {lit("', a line of it starts with ';': ")}"""
    return f"""CASE WHEN {v} IS NULL OR {v} = '' THEN '?'
        WHEN {unwritable(v)} THEN CAST(raise_error(concat({message}, {v})) AS string)
        WHEN {needs_text_field(v)} THEN concat(';', {v}, {eol}, ';')
        WHEN contains({v}, '\\'') THEN concat('"', {v}, '"')
        WHEN {v} RLIKE {lit(_NEEDS_QUOTES)} THEN concat('\\'', {v}, '\\'')
        ELSE {v} END"""


def _cells(frame: DataFrame, columns: Sequence[str]) -> list[tuple[str, str | None]]:
    """(text, is text field or None) per column; numbers need no quoting."""
    out = []
    for c in columns:
        if isinstance(frame.schema[c].dataType, T.StringType):
            out.append((value(f"`{c}`", c), f"coalesce({needs_text_field(f'`{c}`')}, false)"))
        else:
            out.append((f"coalesce(CAST(`{c}` AS string), '?')", None))
    return out


def row(frame: DataFrame, columns: Sequence[str]) -> Column:
    """Text of one loop row: values separated by blanks, text fields on lines of their own.

    The quoting of a cell is one lambda over the row's strings: written out for every column, it made methods that the JVM doesn't compile.
    """
    strings = [c for c in columns if isinstance(frame.schema[c].dataType, T.StringType)]
    if not strings:
        return F.expr("concat_ws(' ', {})".format(", ".join(f"coalesce(CAST(`{c}` AS string), '?')" for c in columns)))
    quoted = value("v", item_text=f"get(array({', '.join(lit(c) for c in strings)}), n)")
    parts, before = [], None
    for c in columns:
        # Only a text field starts with a semicolon: other values that do are quoted.
        here = f"get(row_cells, {strings.index(c)})" if c in strings else None
        fields = [f"startswith({f}, ';')" for f in (before, here) if f is not None]
        if parts:
            parts.append(f"CASE WHEN {' OR '.join(fields)} THEN '\\n' ELSE ' ' END" if fields else "' '")
        parts.append(here or f"coalesce(CAST(`{c}` AS string), '?')")
        before = here
    cells = f"transform(array({', '.join(f'`{c}`' for c in strings)}), (v, n) -> {quoted})"
    return F.expr(f"get(transform(array({cells}), row_cells -> concat({', '.join(parts)})), 0)")


def pairs(frame: DataFrame, category: str, columns: Sequence[str]) -> Column:
    """Text of a key-value category: one ``_category.item value`` per line."""
    lines = []
    for c, (text, field) in zip(columns, _cells(frame, columns)):
        gap = f"CASE WHEN {field} THEN '\\n' ELSE ' ' END" if field is not None else "' '"
        lines += [lit(f"_{category}.{c}"), gap, text, "'\\n'"]
    return F.expr(f"concat({', '.join(lines)})")


def header(category: str, columns: Sequence[str]) -> str:
    return "loop_\n" + "".join(f"_{category}.{c}\n" for c in columns)


def categories(
    tables: dict[str, tuple[DataFrame, Sequence[str]]], keys: Sequence[str], order: str = "row_id", loops: bool = False
) -> DataFrame:
    """Text of several categories per file: ``keys, text``; tables are ``{category: (frame, columns)}`` in file order.

    One shuffle on ``keys`` brings the rows of a file together (a file is the unit CIF is written in). A category with one
    row is written as key-value pairs unless ``loops``; more rows make it a loop.
    """
    parts = []
    for n, (category, (frame, columns)) in enumerate(tables.items()):
        single = F.lit("") if loops else pairs(frame, category, columns)
        parts.append(
            frame.select(
                *keys,
                F.struct(
                    F.lit(n).alias("cat"),
                    F.col(order).cast("bigint").alias("ord"),
                    row(frame, columns).alias("line"),
                    single.alias("pairs"),
                ).alias("r"),
            )
        )
    rows = reduce(DataFrame.unionAll, parts)
    grouped = rows.groupBy(*keys).agg(F.array_sort(F.collect_list("r")).alias("rows"))
    heads = [header(category, columns) for category, (_, columns) in tables.items()]
    texts = []
    for n, head in enumerate(heads):
        own = F.filter("rows", lambda r: r["cat"] == n)
        loop = F.concat(F.lit(head), F.array_join(F.transform(own, lambda r: r["line"]), "\n"), F.lit("\n"))
        text = F.when(F.size(own) == 0, F.lit(None).cast("string"))
        if not loops:
            text = text.when(F.size(own) == 1, F.get(own, 0)["pairs"])
        texts.append(text.otherwise(loop))
    return grouped.select(*keys, F.concat_ws("#\n", *texts).alias("text"))
