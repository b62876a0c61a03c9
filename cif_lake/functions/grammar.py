"""The CIF token grammar as Spark column expressions.

A file is cut three times, each time by one regular expression that runs in the JVM:

* *lexemes*: structural words, quoted values, comments, and long runs of plain values. A lexeme keeps
  the white space behind it, so joining the lexemes of a file gives back its text;
* *rows*: the text of one loop body, ``n`` values at a time;
* *values*: the tokens of one row, only when a column of that row is asked for.

Nothing here recurses: the only repeated group is the row pattern, bounded by the number of columns.

Functions take and give SQL text (a column name, or an expression over lambda variables), to be used with ``F.expr``: one
call builds a whole expression, where the Column API takes one call to the JVM for every operator of every column.
"""

from __future__ import annotations

# Flags: d = only \n ends a line, m = ^ matches at each line, s = . matches \n.
_FLAGS = "(?dms)"
_QUOTED = (
    r"^;.*?(?:\n;|\z)"
    r"|'''.*?(?:'''|\z)"
    r'|""".*?(?:"""|\z)'
    r"|'.*?(?:'(?=\s|\z)|\z)"
    r'|".*?(?:"(?=\s|\z)|\z)'
)
# Most values start with neither a quote nor a semicolon: tried first.
_ANY = rf"""[^\s'";]\S*+|{_QUOTED}|\S++"""
VALUE = _FLAGS + rf"(?:{_ANY})"
LEXEME = _FLAGS + rf"""\G(?:{_QUOTED}|#[^\n]*+|[^'"#;_]*\s|\S++)\s*+"""
# A value or a comment with the white space behind it.
PIECE = _FLAGS + rf"\G(?:(?>{_QUOTED}|#[^\n]*+|\S++)\s*+)"

# As the row pattern, but each value keeps the comments in front of it; the width goes in between.
ROW_WITH_COMMENTS = (_FLAGS + rf"\G(?:(?:(?>#[^\n]*+)\s*+)*+(?>{_QUOTED}|[^\s#]\S*+)\s*+){{1,", "}+")


def lit(text: str) -> str:
    """SQL literal."""
    for plain, escaped in (("\\", "\\\\"), ("'", "\\'"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\x00", "\\0")):
        text = text.replace(plain, escaped)
    return f"'{text}'"


def row_pattern(width: str) -> str:
    """Pattern that takes up to ``width`` values of a loop body at a time.

    A row keeps the white space in front of it, so a ``;`` that opens it is still seen to be in column 1 or not.
    """
    return f"concat({lit(_FLAGS + rf'\G(?:\s*+(?>{_ANY})){{1,')}, {width}, '}}+')"


def all_of(text: str, pattern: str) -> str:
    return f"regexp_extract_all({text}, {pattern}, 0)"


def lexemes(text: str) -> str:
    return all_of(text, lit(LEXEME))


def values(text: str) -> str:
    """Raw tokens (with their quotes) of a piece of text that holds no comments."""
    return all_of(text, lit(VALUE))


def pieces(text: str) -> str:
    return all_of(text, lit(PIECE))


def is_comment(lexeme: str) -> str:
    return f"startswith({lexeme}, '#')"


def without_comments(text_lexemes: str) -> str:
    """Join lexemes to text, each comment cut back to the white space behind it: a blank there keeps a ``;`` out of column 1."""
    rest = f"regexp_replace(wc, {lit('^#[^' + chr(10) + ']*')}, '')"
    return f"array_join(transform({text_lexemes}, wc -> CASE WHEN startswith(wc, '#') THEN {rest} ELSE wc END), '')"


def block_starts(lex: str) -> str:
    """Positions (from 1) of the block headers."""
    return f"filter(transform({lex}, (x, i) -> CASE WHEN lower(left(x, 5)) = 'data_' THEN i + 1 END), p -> p IS NOT NULL)"


def header_name(lexeme: str) -> str:
    """``x`` of ``data_x`` or ``save_x``."""
    return f"regexp_extract({lexeme}, {lit(r'(?s)^.{5}(\S*)')}, 1)"


def kind(lexeme: str, previous: str) -> str:
    """Structural kind: D(ata block), L(oop), S(ave frame), T(ag), X (other reserved word), or NULL for a value.

    ``data_`` counts anywhere between values; the other words count at the start of a line or
    behind another structural word, so a stray ``_x`` inside a row stays a value.
    """
    x, p = lexeme, previous
    return f"""CASE WHEN NOT startswith({x}, '_') AND lower(left({x}, 5)) = 'data_' THEN 'D'
        WHEN (startswith({x}, '_') OR lower(left({x}, 5)) IN ('loop_', 'save_')
              OR (startswith({p}, '_') AND (lower(left({x}, 5)) = 'stop_' OR lower(left({x}, 7)) = 'global_')))
         AND ({p} IS NULL OR startswith({p}, '_') OR endswith({p}, '\\n') OR lower(left({p}, 5)) IN ('loop_', 'data_', 'save_')
              OR {p} RLIKE {lit(r"\n\s*\z")} OR NOT {p} RLIKE {lit(r"\S")})
        THEN CASE WHEN startswith({x}, '_') THEN 'T' WHEN lower(left({x}, 5)) = 'loop_' THEN 'L'
                  WHEN lower(left({x}, 5)) = 'save_' THEN 'S' ELSE 'X' END END"""


def may_be_structural(lexeme: str) -> str:
    """A test that few values pass, without a regular expression; ``kind`` decides."""
    return f"(startswith({lexeme}, '_') OR lower(left({lexeme}, 5)) IN ('data_', 'loop_', 'save_', 'stop_', 'globa'))"


def tag_part(lexeme: str, part: int) -> str:
    """Category (1) or item (2) of a ``_category.item`` tag; NULL when the tag has no dot.

    A lexeme that starts with ``_`` is one word with white space behind it.
    """
    if part == 1:
        return f"CASE WHEN contains({lexeme}, '.') THEN substring(substring_index({lexeme}, '.', 1), 2) END"
    word = f"substring({lexeme}, instr({lexeme}, '.') + 1)"
    return f"CASE WHEN contains({lexeme}, '.') THEN trim(TRAILING ' \\t\\n\\r\\u000b\\u000c' FROM {word}) END"


def is_null(raw: str) -> str:
    return f"({raw} IS NULL OR {raw} IN ('.', '?'))"


def is_text_field(raw: str) -> str:
    return f"(startswith({raw}, ';') AND contains({raw}, '\\n'))"


def is_quoted(raw: str) -> str:
    return f"(left({raw}, 1) IN ('\\'', '\"') OR {is_text_field(raw)})"


def unquote(raw: str) -> str:
    """The value behind a raw token; NULL for a bare ``.`` or ``?``."""
    r = raw
    return f"""CASE WHEN {is_null(r)} THEN NULL
        WHEN left({r}, 1) IN ('\\'', '\"') THEN CASE
            WHEN length({r}) >= 6 AND left({r}, 3) = repeat(left({r}, 1), 3) AND right({r}, 3) = repeat(left({r}, 1), 3)
            THEN substring({r}, 4, length({r}) - 6)
            WHEN length({r}) >= 2 AND left({r}, 1) = right({r}, 1) THEN substring({r}, 2, length({r}) - 2)
            ELSE substring({r}, 2) END
        WHEN {is_text_field(r)} THEN regexp_replace(substring({r}, 2), {lit(chr(92) + "r?" + chr(92) + "n;" + chr(92) + "z")}, '')
        ELSE {r} END"""


def typed(value: str, dtype: str, where: str, on_malformed: str = "error") -> str:
    """Cast text to a dictionary type. Whole numbers round half away from zero, as in ``2.5`` -> 3.

    ``where`` is SQL text that names the place in the error message.
    """
    if dtype == "string":
        return value
    # Spark also takes suffixes (1.5d), hexadecimal floats and words; a number of a file is digits, a point and an exponent.
    number = f"trim({value}) RLIKE {lit(r'^[+-]?(?:[0-9]+[.]?[0-9]*|[.][0-9]+)(?:[eE][+-]?[0-9]+)?$')}"
    if dtype == "bigint":
        # Digits far behind the point are cut, not rounded: they must not carry into the first one, which decides.
        far = lit(r"^([^eE]*[.][0-9]{18})[0-9]+$")
        cut = f"regexp_replace(trim({value}), {far}, '$1')"
        wide = f"try_cast({cut} AS decimal(38,18))"
        half = f"try_cast(round({wide}) AS decimal(38,0))"
        cast = f"CASE WHEN {number} THEN coalesce(try_cast(trim({value}) AS bigint), try_cast({half} AS bigint)) END"
    elif dtype == "double":
        word = f"lower(trim({value})) RLIKE '^(?:nan|[+-]?inf(?:inity)?)$'"
        real = f"try_cast(trim({value}) AS double)"
        # Digits that overflow are malformed; infinity has to be written as such.
        cast = f"CASE WHEN {word} THEN {real} WHEN {number} AND abs({real}) < double('infinity') THEN {real} END"
    else:
        cast = f"try_cast({value} AS {dtype})"
    if on_malformed == "null":
        return cast
    error = f"CAST(raise_error(concat('malformed {dtype} in ', {where}, ': ', {value})) AS {dtype})"
    return f"CASE WHEN {value} IS NOT NULL THEN coalesce({cast}, {error}) END"
