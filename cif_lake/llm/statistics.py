"""Statistics of one text, exact and in one pass over its words: what the quality operators look at.

Words are runs of characters other than blank, tab, newline, vertical tab, form feed and carriage return. A null or empty text has
no words, and all its statistics are zero.
"""

from __future__ import annotations

import numpy as np

SYMBOLS = b"#*$%&|<>"
#: The exact counts, in the order of ``Counts``.
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Features by name, and the way quality may depend on them: -1 never rises, 0 free.
FEATURES = {
    "log_words": 0, "word_length": 0, "symbol_rate": -1, "dup_line_rate": -1, "repeat_rate": -1, "upper_rate": -1, "digit_rate": -1, "punctuation_rate": 0, "bang_rate": -1,
    "pipe_rate": -1, "distinct_rate": 0, "top_word_rate": -1, "beyond_ascii_rate": 0, "log_lines": 0, "words_a_line": 0,
}

_BYTES = np.arange(256)
_BLANK = np.isin(_BYTES, list(b"\t\n\v\f\r "))
_LATER = (_BYTES & 0xC0) == 0x80
_SYMBOL = np.isin(_BYTES, list(SYMBOLS))
_UPPER, _LOWER, _DIGIT = ((_BYTES >= a) & (_BYTES <= b) for a, b in (b"AZ", b"az", b"09"))
_MARK = (_BYTES > 32) & (_BYTES < 127) & ~(_UPPER | _LOWER | _DIGIT)


def repeated_words(ids: np.ndarray, n: int = 3) -> int:
    """Words inside windows of ``n`` words that occur twice or more in the text, the first time included."""
    if len(ids) <= n:
        return 0
    code = ids[: len(ids) - n + 1].astype(np.int64)
    for k in range(1, n):
        following = ids[k : len(ids) - n + 1 + k]
        top = int(ids.max()) + 1
        if int(code.max()) + 1 > (1 << 62) // top:
            code = np.unique(code, return_inverse=True)[1].astype(np.int64)
        code = code * top + following
    ordered = np.sort(code)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    twice = np.unique(twice)
    at = twice[np.minimum(np.searchsorted(twice, code), len(twice) - 1)] == code
    inside = np.zeros(len(ids), bool)
    for k in range(n):
        inside[k : k + len(at)] |= at
    return int(inside.sum())


def statistics(text: bytes | None) -> tuple[list[int], list[float]]:
    """The counts and the features of a text in UTF-8."""
    text = text or b""
    words = text.split()
    n = len(words)
    if not n:
        return [0] * len(COUNTS), [0.0] * len(FEATURES)
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    chars = len(text) - int(seen[_LATER].sum())
    word_chars = chars - int(seen[_BLANK].sum())
    symbols = int(seen[_SYMBOL].sum())
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    copies = len(lines) - len(set(lines))
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    repeats = repeated_words(ids)
    upper = int(seen[_UPPER].sum())
    features = [
        np.log1p(n), word_chars / n, symbols / word_chars, copies / len(lines), repeats / n, upper / max(1, upper + int(seen[_LOWER].sum())), int(seen[_DIGIT].sum()) / word_chars,
        int(seen[_MARK].sum()) / word_chars, int(seen[33]) / n, int(seen[124]) / n, len(number) / n, int(np.bincount(ids).max()) / n, int(seen[128:].sum()) / len(text),
        np.log1p(len(lines)), np.log1p(n / len(lines)),
    ]
    return [n, word_chars, symbols, copies, repeats], [float(f) for f in features]
