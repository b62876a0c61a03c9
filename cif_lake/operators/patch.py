"""Write edits back into CIF text: only the bytes of what was edited change.

``edits(path, block_name, category, op, row_id, item, value)``: ``op`` is ``update`` (one row per cell), ``delete`` (``row_id``
only) or ``insert`` (one row per cell; ``row_id`` orders the new rows). A NULL ``block_name`` means the first block.

Text is handled as ISO-8859-1, one character per byte, so bytes that are not valid UTF-8 survive too.

The edits of a file become one row: a list of edited categories, each with its changed rows in order. That row meets the file's text
in one join, by broadcast where the edits were measured to be small, so the text itself is not shuffled. All else is a sequence of
array steps over that one row: find the categories among the file's lexemes, cut them to rows, rewrite the rows that have edits (the
others are only joined again) and collect a sorted list of splices ``(begin, width, text)`` in bytes, applied in one expression.
Deleted tokens are marked with a NUL character first; which blanks and line ends go with them is then a matter of four replacements.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cif_lake.functions import grammar as g
from cif_lake.functions import render
from cif_lake.operators.relational import use_checkpoints
from cif_lake.sources import read

GONE = "\x00"
_RUN = r"\x00(?:[\s\x00]*\x00)?"
#: Edits of up to so many bytes, measured as JSON, are sent to the files; larger ones meet them by a shuffle.
BROADCAST_BYTES = 64 << 20


def _latin(src: DataFrame) -> DataFrame:
    """Source frame whose content is a string of bytes-as-characters."""
    return read.raw(src).withColumn("content", F.decode("content", "ISO-8859-1"))


# --- edits ------------------------------------------------------------------------------------------------------------


def edits_by_path(edits: DataFrame) -> DataFrame:
    """One row per file: ``path, edits[(want, category, changes[(row_id, gone, up)], added[(row_id, cells)], fault)]``.

    ``up`` and ``cells`` are lists of ``(item, value)``, ``want`` is the block in lower case; ``fault`` is what is wrong with edits whatever
    the file holds. The only shuffle is that of the edits, by path.
    """
    value = "decode(encode(value, 'UTF-8'), 'ISO-8859-1')"
    cell = f"struct(lower(item) AS item, {value} AS value)"
    rows = (
        edits.repartition("path")
        .withColumns({"want": F.lower("block_name"), "category": F.lower("category")})
        .groupBy("path", "want", "category", "row_id")
        .agg(
            F.expr("max(CASE WHEN op IS NULL OR op NOT IN ('update', 'delete', 'insert') THEN coalesce(op, 'NULL') END) AS strange"),
            F.expr("count_if(op = 'delete') AS deletes"),
            F.expr("count_if(op IN ('update', 'insert') AND item IS NULL) AS nameless"),
            F.expr(f"collect_list(CASE WHEN op = 'update' THEN {cell} END) AS up"),
            F.expr(f"collect_list(CASE WHEN op = 'insert' THEN {cell} END) AS cells"),
        )
    )
    twin = "get(filter(transform({0}, (c, i) -> CASE WHEN exists(slice({0}, 1, i), d -> d.item = c.item) THEN c.item END), c -> c IS NOT NULL), 0)"
    twins = f"coalesce({twin.format('up')}, {twin.format('cells')})"
    fault = f"""CASE WHEN strange IS NOT NULL THEN concat('unknown operation ', strange)
        WHEN row_id IS NULL THEN 'an edit without a row_id' WHEN nameless > 0 THEN 'a cell without an item'
        WHEN deletes > 1 OR (deletes > 0 AND size(up) > 0) THEN concat('two operations on row ', row_id, ' of ', category)
        WHEN {twins} IS NOT NULL THEN concat('two values for ', {twins}, ' in row ', row_id, ' of ', category) END"""
    regions = rows.selectExpr("*", f"{fault} AS fault").groupBy("path", "want", "category").agg(
        F.expr("array_sort(collect_list(CASE WHEN deletes > 0 OR size(up) > 0 THEN struct(row_id, deletes > 0 AS gone, up) END)) AS changes"),
        F.expr("array_sort(collect_list(CASE WHEN size(cells) > 0 THEN struct(row_id, cells) END)) AS added"),
        F.min("fault").alias("fault"),
    )
    return regions.groupBy("path").agg(F.expr("collect_list(struct(want, category, changes, added, fault)) AS edits"))


# --- steps over the edited categories of one file -----------------------------------------------------------------------
#
# Columns run in parallel, one element for each edited category k: ``edits``, ``regs`` (a few numbers and names, as each step copies
# them), ``parts`` and ``segs`` (its text), ``rows`` (those that are rewritten).


def _step(frame: DataFrame, **new: str) -> DataFrame:
    """Add fields to each element ``r`` (number ``k``) of the list ``regs``; one stage, so that no field is computed twice."""
    known = [f for f in frame.schema["regs"].dataType.elementType.names if f not in new]
    fields = [f"'{f}', r.{f}" for f in known] + [f"'{f}', {text}" for f, text in new.items()]
    return _column(frame, regs=f"transform(regs, (r, k) -> named_struct({', '.join(fields)}))")


def _column(frame: DataFrame, *gone: str, **new: str) -> DataFrame:
    """Add columns, drop others."""
    kept = [c for c in frame.columns if c not in gone and c not in new]
    return frame.selectExpr(*kept, *[f"{text} AS {name}" for name, text in new.items()])


def _row_step(frame: DataFrame, **new: str) -> DataFrame:
    """As ``_step``, for each rewritten row ``x``; its category is ``get(regs, k)``."""
    known = [f for f in frame.schema["rows"].dataType.elementType.elementType.names if f not in new]
    fields = [f"'{f}', x.{f}" for f in known] + [f"'{f}', {text}" for f, text in new.items()]
    return _column(frame, rows=f"transform(rows, (xs, k) -> transform(xs, x -> named_struct({', '.join(fields)})))")


def _stop(message: str, kind: str) -> str:
    return f"CAST(raise_error(concat('cannot apply an edit to ', path, ': ', {message})) AS {kind})"


def _placed(files: DataFrame) -> DataFrame:
    """Find the edited categories: ``path, content, edits, regs, parts``; ``files`` have ``path, content, edits``."""
    lexed = files.selectExpr("path", "content", "edits", f"{g.lexemes('content')} AS lex")
    found = lexed.selectExpr("*", f"{g.block_starts('lex')} AS starts")
    one = f"named_struct('name', lower({g.header_name('element_at(lex, p)')}), 'from', p, 'to', coalesce(get(starts, i + 1), size(lex) + 1))"
    # A file without a block header is one block without a name.
    whole = "array(named_struct('name', CAST(NULL AS string), 'from', 1, 'to', size(lex) + 1))"
    found = found.selectExpr("*", f"CASE WHEN size(starts) > 0 THEN transform(starts, (p, i) -> {one}) ELSE {whole} END AS blocks")
    found = _column(read.marks(found), "starts").selectExpr("*", "transform(marks, m -> lower(m.cat)) AS keys", f"{read.CUTS} AS cuts")
    hits = "CASE WHEN e.want IS NULL THEN slice(blocks, 1, 1) ELSE filter(blocks, b -> b.name = e.want) END"
    regs = _column(found, "blocks", regs=f"transform(edits, e -> named_struct('category', e.category, 'want', e.want, 'fault', e.fault, 'hits', {hits}))")
    fault = "CASE WHEN r.fault IS NOT NULL THEN r.fault WHEN size(r.hits) = 0 THEN concat('no block ', r.want) WHEN size(r.hits) > 1 THEN concat('block ', r.want, ' is ambiguous') END"
    regs = _step(regs, fault=fault)
    block = f"CASE WHEN r.fault IS NULL THEN get(r.hits, 0) ELSE {_stop('r.fault', 'struct<name:string,from:int,to:int>')} END"
    regs = _column(regs, regs=f"transform(regs, r -> named_struct('category', r.category, 'block', {block}))")
    # The block's marks, from the first on and before the last.
    bound = lambda p: f"1 + size(filter(marks, m -> m.p < {p}))"
    regs = _column(regs, regs=f"transform(regs, r -> named_struct('category', r.category, 'from', {bound('r.block.from')}, 'to', {bound('r.block.to')}))")
    regs = _step(regs, f="CAST(array_position(slice(keys, r.from, r.to - r.from), r.category) AS int)")
    absent = _stop("concat('category ', coalesce(r.category, 'NULL'), ' is not in the block')", "int")
    regs = _step(_column(regs, "keys"), f=f"CASE WHEN r.f > 0 THEN r.from + r.f - 1 ELSE {absent} END")
    regs = _step(regs, is_loop="coalesce(get(marks, r.f - 2).k = 'L', false)", spelling="get(marks, r.f - 1).cat")
    run = "least(coalesce(get(filter(cuts, c -> c > r.f), 0), size(marks) + 1), r.to) - r.f"
    regs = _step(regs, run=run)
    regs = _column(regs, "marks", "cuts", tags=f"transform(regs, r -> slice(marks, r.f, {read.tags_of('r')}))")
    last = "element_at(get(tags, k), -1)"
    regs = _step(
        regs,
        items="transform(get(tags, k), t -> t.item)",
        start=f"CASE WHEN r.is_loop THEN {last}.p ELSE get(get(tags, k), 0).p END",
        lead=f"CASE WHEN r.is_loop THEN element_at(lex, {last}.p) ELSE '' END",
    )
    # The body of a loop, or the items of a key-value category; offsets count characters, which are bytes here.
    body = f"CASE WHEN r.is_loop THEN array(array_join(slice(lex, {last}.p + 1, {last}.n), '')) ELSE transform(get(tags, k), t -> array_join(slice(lex, t.p, t.n + 1), '')) END"
    regs = _column(regs, parts=f"transform(regs, (r, k) -> {body})")
    regs = _step(regs, begin="length(array_join(slice(lex, 1, r.start - 1), '')) + 1", width="length(r.lead) + length(array_join(get(parts, k), ''))")
    eol = "CASE WHEN contains(r.lead, '\\r\\n') OR exists(get(parts, k), x -> contains(x, '\\r\\n')) THEN '\\r\\n' ELSE '\\n' END"
    regs = _step(regs, eol=eol, adds="size(get(edits, k).added) > 0")
    return _column(regs, "lex", "tags")


def _cut(regs: DataFrame) -> DataFrame:
    """Cut the categories to rows ``segs`` (each with the comments in front of it) and check rows and items of the edits.

    A cut-short last row gets a ``?`` for each missing value, where an edit needs it.
    """
    cut = g.all_of("get(get(parts, k), 0)", f"concat({g.lit(g.ROW_WITH_COMMENTS[0])}, size(r.items), {g.lit(g.ROW_WITH_COMMENTS[1])})")
    regs = _column(regs, segs=f"transform(regs, (r, k) -> CASE WHEN r.is_loop THEN {cut} ELSE get(parts, k) END)")
    changes, added, segs = "get(edits, k).changes", "get(edits, k).added", "get(segs, k)"
    named = f"concat(flatten(transform({changes}, c -> transform(c.up, u -> u.item))), flatten(transform({added}, a -> transform(a.cells, u -> u.item))))"
    regs = _step(
        regs,
        n=f"size({segs})",
        low="transform(r.items, i -> lower(i))",
        outside=f"get(filter({changes}, c -> c.row_id < 0 OR c.row_id >= CASE WHEN r.is_loop THEN size({segs}) ELSE 1 END), 0).row_id",
        last=f"CASE WHEN r.is_loop AND size({segs}) > 0 THEN {g.pieces(f'element_at({segs}, -1)')} ELSE CAST(array() AS array<string>) END",
        # What follows the last row of a loop.
        tail=f"CASE WHEN r.is_loop THEN substring(get(get(parts, k), 0), length(array_join({segs}, '')) + 1) ELSE '' END",
    )
    regs = _step(_column(regs, "parts"), strange=f"get(array_except({named}, r.low), 0)")
    fault = "CASE WHEN r.strange IS NOT NULL THEN concat('no item ', r.strange, ' in ', r.category) ELSE concat('no row ', r.outside, ' in ', r.category) END"
    regs = _step(
        regs,
        category=f"CASE WHEN r.strange IS NULL AND r.outside IS NULL THEN r.category ELSE {_stop(fault, 'string')} END",
        missing=f"CASE WHEN size(r.last) > 0 THEN size(r.items) - size(filter(r.last, x -> NOT {g.is_comment('x')})) ELSE 0 END",
        value_at=f"array_max(transform(r.last, (x, i) -> CASE WHEN NOT {g.is_comment('x')} THEN i END))",
    )
    needed = f"exists({changes}, c -> c.row_id = r.n - 1 AND exists(c.up, u -> array_position(r.low, u.item) > size(r.items) - r.missing))"
    regs = _step(regs, fills=f"r.missing > 0 AND (r.adds OR {needed})")
    blank = f"regexp_extract(x, {g.lit(r'(?s)(\s*)\z')}, 1)"
    full = f"concat(substring(x, 1, length(x) - length({blank})), repeat(' ?', r.missing), {blank})"
    row = f"array_join(transform(r.last, (x, i) -> CASE WHEN i = r.value_at THEN {full} ELSE x END), '')"
    kept = ["category", "spelling", "is_loop", "items", "begin", "width", "eol", "lead", "tail", "n", "adds"]
    light = ", ".join(f"'{f}', r.{f}" for f in kept)
    return _column(
        regs,
        segs=f"transform(regs, (r, k) -> CASE WHEN r.fills THEN concat(slice({segs}, 1, r.n - 1), array({row})) ELSE {segs} END)",
        regs=f"transform(regs, r -> named_struct({light}))",
    )


def _rewritten(regs: DataFrame) -> DataFrame:
    """Rewrite the rows that have edits, and the last one: ``rows[[(no, main, rest, gone)]]``; ``main`` ends with the last value."""
    changes, segs, r = "get(edits, k).changes", "get(segs, k)", "get(regs, k)"
    none = "CAST(array() AS array<struct<item:string,value:string>>)"
    edited = f"transform({changes}, c -> named_struct('no', CAST(c.row_id AS int), 'gone', c.gone, 'up', c.up))"
    plain = f"array(named_struct('no', r.n - 1, 'gone', false, 'up', {none}))"
    more = f"CASE WHEN r.n = 0 OR exists({changes}, c -> c.row_id = r.n - 1) THEN array() ELSE {plain} END"
    # All items of a key-value category are its row 0.
    first = f"get({changes}, 0)"
    of_pairs = f"transform({segs}, (s, i) -> named_struct('no', i, 'gone', coalesce({first}.gone, false), 'up', coalesce({first}.up, {none})))"
    regs = _column(regs, rows=f"transform(regs, (r, k) -> CASE WHEN r.is_loop THEN concat({edited}, {more}) ELSE {of_pairs} END)")
    regs = _row_step(
        regs,
        cut=g.pieces(f"get({segs}, x.no)"),
        at_line=f"coalesce(right(get({segs}, x.no - 1), 1) = '\\n', right({r}.lead, 1) IN ('\\n', ''))",
        more=f"x.no < {r}.n - 1 OR length({r}.tail) > 0",
        eol=f"{r}.eol",
        is_loop=f"{r}.is_loop",
        # Key-value rows that get company become a loop: the tags leave the values.
        promoted=f"NOT {r}.is_loop AND {r}.adds AND NOT x.gone",
        own=f"get(filter(x.up, u -> u.item = lower(get({r}.items, x.no))), 0)",
    )
    # Every piece with the number of its token in the row.
    numbered = (
        "named_struct('x', p, 'ws', regexp_extract(p, '(?s)(\\\\s*)\\\\z', 1), "
        "'k', size(filter(slice(x.cut, 1, i), y -> NOT startswith(y, '#'))), 'comment', startswith(p, '#'), "
        "'at_line', CASE WHEN i = 0 THEN x.at_line ELSE right(get(x.cut, i - 1), 1) = '\\n' END, 'more', i < size(x.cut) - 1 OR x.more)"
    )
    regs = _row_step(regs, cut=f"transform(x.cut, (p, i) -> {numbered})")
    regs = _row_step(regs, has_value="exists(x.cut, p -> NOT p.comment AND p.k = 1)")
    role = "CASE WHEN p.comment THEN 'comment' WHEN NOT x.is_loop AND p.k = 0 THEN 'tag' WHEN x.is_loop OR p.k = 1 THEN 'value' ELSE 'stray' END"
    of_row = f"get(filter(x.up, u -> u.item = lower(get({r}.items, p.k))), 0)"
    found = f"CASE WHEN {role} = 'value' THEN CASE WHEN x.is_loop THEN {of_row} ELSE x.own END WHEN {role} = 'tag' AND NOT x.has_value THEN x.own END"
    piece = f"named_struct('x', p.x, 'ws', p.ws, 'at_line', p.at_line, 'more', p.more, 'comment', p.comment, 'role', {role}, 'found', {found})"
    regs = _row_step(regs, cut=f"transform(x.cut, p -> {piece})")
    field = f"coalesce({render.needs_text_field('p.found.value')}, false)"
    shown = render.value("p.found.value", eol="x.eol")
    replaced = (
        f"concat(CASE WHEN {field} AND NOT p.at_line THEN x.eol ELSE '' END, {shown}, "
        f"CASE WHEN {field} AND p.more AND NOT contains(p.ws, '\\n') THEN x.eol ELSE '' END, p.ws)"
    )
    tag = (
        "concat(CASE WHEN x.promoted THEN '' ELSE substring(p.x, 1, length(p.x) - length(p.ws)) END, "
        f"CASE WHEN p.found IS NOT NULL THEN concat(CASE WHEN {field} THEN x.eol ELSE ' ' END, {shown}) "
        "WHEN x.promoted AND NOT x.has_value THEN ' ?' ELSE '' END, "
        f"CASE WHEN x.promoted AND x.has_value THEN regexp_replace(p.ws, {g.lit(r'^[ \t\r]*\n')}, '') ELSE p.ws END)"
    )
    text = (
        f"CASE WHEN x.gone AND p.role IN ('tag', 'value') THEN concat({g.lit(GONE)}, p.ws) WHEN p.role = 'tag' THEN {tag} "
        f"WHEN p.role = 'value' AND p.found IS NOT NULL THEN {replaced} ELSE p.x END"
    )
    end = "array_max(transform(x.cut, (p, i) -> CASE WHEN NOT p.comment THEN i + 1 END))"
    made = f"named_struct('no', x.no, 'gone', x.gone, 'texts', transform(x.cut, p -> {text}), 'end', {end})"
    regs = _column(regs, rows=f"transform(rows, xs -> transform(xs, x -> {made}))")
    # New rows go behind the line of the last value: comments further down stay behind them.
    seg = "named_struct('no', x.no, 'main', array_join(slice(x.texts, 1, x.end), ''), 'rest', array_join(slice(x.texts, x.end + 1, size(x.texts)), ''), 'gone', x.gone)"
    return _column(regs, rows=f"transform(rows, xs -> transform(xs, x -> {seg}))")


def _renewed(regs: DataFrame) -> DataFrame:
    """The new text of each edited category: ``splices[(begin, width, text)]``."""
    xs, added = "get(rows, k)", "get(edits, k).added"
    # Rows without edits between the rewritten ones are joined as they are.
    before = "coalesce(get(xs, j - 1).no, -1)"
    gap = f"array_join(slice(get(segs, k), {before} + 2, x.no - {before} - 1), '')"
    body = f"array_join(transform(xs, (x, j) -> concat({gap}, CASE WHEN j < size(xs) - 1 THEN concat(x.main, x.rest) ELSE '' END)), '')"
    regs = _column(regs, bodies=f"transform(rows, (xs, k) -> {body})")
    regs = _step(
        regs, main=f"coalesce(get({xs}, size({xs}) - 1).main, '')", rest=f"coalesce(get({xs}, size({xs}) - 1).rest, '')", gone=f"exists({xs}, x -> x.gone)"
    )
    # Head: up to the end of the line of the last value. An empty loop takes new rows at its very end.
    regs = _step(regs, line=f"regexp_extract(r.main, {g.lit(r'(?s)^(.*\S[^\S\n]*\n?)\s*\z')}, 1)")
    regs = _step(
        regs,
        last="right(concat(right(r.lead, 1), right(get(bodies, k), 1), right(r.line, 1)), 1)",
        after="concat(substring(r.main, length(r.line) + 1), r.rest, r.tail)",
    )
    # A comment behind the last value finishes its line.
    moved = (
        "CASE WHEN r.n = 0 THEN r.after WHEN r.last <> '\\n' AND length(r.after) > 0 "
        f"THEN regexp_extract(r.after, {g.lit(r'^([^\n]*\n?)')}, 1) ELSE '' END"
    )
    regs = _step(regs, moved=moved)
    cells = f"transform({added}, a -> transform(r.items, i -> get(filter(a.cells, c -> c.item = lower(i)), 0).value))"
    header = "concat('loop_', r.eol, array_join(transform(r.items, i -> concat('_', r.spelling, '.', i, r.eol)), ''))"
    regs = _step(regs, last="right(concat(r.last, right(r.moved, 1)), 1)", after="substring(r.after, length(r.moved) + 1)", header=header)
    regs = _column(regs, cells=f"transform(regs, (r, k) -> {cells})")
    field = lambda v: f"coalesce({render.needs_text_field(v)}, false)"
    shown = render.value("v", eol="r.eol")
    gap = f"CASE WHEN i = 0 THEN '' WHEN {field('v')} OR {field('get(c, i - 1)')} THEN r.eol ELSE ' ' END"
    loop_row = f"concat(array_join(transform(c, (v, i) -> concat({gap}, {shown})), ''), r.eol)"
    loop_rows = f"array_join(transform(get(cells, k), c -> {loop_row}), '')"
    pair = f"concat('_', r.spelling, '.', get(r.items, i), CASE WHEN {field('v')} THEN r.eol ELSE ' ' END, {shown}, r.eol)"
    new = (
        f"CASE WHEN NOT r.adds THEN '' WHEN r.is_loop OR NOT r.gone THEN {loop_rows} WHEN size({added}) > 1 THEN concat(r.header, {loop_rows}) "
        f"ELSE array_join(transform(get(get(cells, k), 0), (v, i) -> {pair}), '') END"
    )
    regs = _step(regs, new=new)
    promote = "CASE WHEN r.adds AND NOT r.is_loop AND NOT r.gone THEN r.header ELSE '' END"
    open_end = "CASE WHEN r.new <> '' AND r.last <> '\\n' THEN r.eol ELSE '' END"
    whole = f"concat({promote}, r.lead, get(bodies, k), r.line, r.moved, {open_end}, r.new, r.after)"
    clean = whole
    for pattern, kept in (
        (r"(?d)\n[ \t\r]*" + _RUN + r"[ \t\r]*\z", ""),
        (r"(?dm)^[ \t\r]*" + _RUN + r"[ \t\r]*\n", ""),
        (r"(?dm)^([ \t]*)" + _RUN + r"[ \t\r]*", "$1"),
        (r"[ \t\r]*" + _RUN, ""),
    ):
        clean = f"regexp_replace({clean}, {g.lit(pattern)}, '{kept}')"
    splice = f"named_struct('begin', r.begin, 'width', r.width, 'text', CASE WHEN r.gone THEN {clean} ELSE {whole} END)"
    return _column(regs, "edits", "segs", "rows", "bodies", "cells", "regs", splices=f"array_sort(transform(regs, (r, k) -> {splice}))")


def spliced(content: str, splices: str, path: str = "path") -> str:
    """Text with pieces replaced: SQL text. ``splices[(begin, width, text)]`` are in order; two that overlap stop the job."""
    end = "CASE WHEN i = 0 THEN 1 ELSE get({0}, i - 1).begin + get({0}, i - 1).width END".format(splices)
    clash = f"CAST(raise_error(concat('two edits overlap in ', {path})) AS string)"
    kept = f"CASE WHEN s.begin < {end} THEN {clash} ELSE substring({content}, {end}, s.begin - ({end})) END"
    behind = f"coalesce(get({splices}, size({splices}) - 1).begin + get({splices}, size({splices}) - 1).width, 1)"
    return f"concat(array_join(transform({splices}, (s, i) -> concat({kept}, s.text)), ''), substring({content}, {behind}))"


def patch_files(src: DataFrame, edits: DataFrame) -> DataFrame:
    """Source frame of the edited files; files without edits are not in it.

    An edit that has no place stops the job: an unknown file, block, category, item or row, two values for one cell, a row that
    is deleted and edited or deleted twice. Where a loop ends in the middle of a row, an edit of its missing cells or a new
    row behind it fills the row with ``?`` first. The edits are checkpointed once and measured; the text is read once.
    """
    use_checkpoints(src.sparkSession)
    wanted = edits_by_path(edits).checkpoint()
    held = wanted.agg(F.sum(F.octet_length(F.to_json(F.struct("path", "edits"))))).first()[0] or 0
    files = _latin(src).select("path", "content").join(F.broadcast(wanted) if held <= BROADCAST_BYTES else wanted, "path")
    nul = "CAST(raise_error(concat('NUL byte in ', path)) AS string)"
    files = files.selectExpr("path", f"CASE WHEN contains(content, {g.lit(GONE)}) THEN {nul} ELSE content END AS content", "edits")
    done = _renewed(_rewritten(_cut(_placed(files))))
    out = done.selectExpr("0 AS file_ord", "path", f"encode({spliced('content', 'splices')}, 'ISO-8859-1') AS content")
    # Edits of files that are not there: no rows, or the end of the job.
    lost = wanted.select("path").join(src.select("path").distinct(), "path", "left_anti")
    stop = "raise_error(concat('cannot apply an edit to ', coalesce(path, 'NULL'), ': no such file'))"
    return out.unionByName(lost.selectExpr("0 AS file_ord", "path", f"CAST({stop} AS binary) AS content"))


def edits_of(frame: DataFrame, category: str, op: str, items: list[str], block_name: str | None = None) -> DataFrame:
    """Edits from a wide frame ``path, row_id, items``: one row per cell (for ``delete``, one per row)."""
    lead = ["path", F.lit(block_name).cast("string").alias("block_name"), F.lit(category).alias("category"), F.lit(op).alias("op"), F.col("row_id").cast("bigint").alias("row_id")]
    none = F.lit(None).cast("string")
    if op == "delete":
        return frame.select(*lead, none.alias("item"), none.alias("value"))
    cells = F.array(*[F.struct(F.lit(i).alias("item"), F.col(i).cast("string").alias("value")) for i in items])
    return frame.select(*lead, F.explode(cells).alias("c")).select("path", "block_name", "category", "op", "row_id", "c.item", "c.value")


def union_edits(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
