"""Byte-level BPE by prefix dynamic programming.

A piece of text has one valid encoding, and so has each of its byte prefixes: the encoding of a prefix ends in one token, and what
comes before that token is the valid encoding of a shorter prefix. So it is enough to keep, for each prefix, its last token. A
token may follow another if their border survives: undoing their merges from the latest to the earliest, no pair at the border may
be one that would have been merged sooner. Appending to a piece goes on from the stored last tokens, and an edit keeps all those
before it.

Ranks are a table of tokens, as in a ``.tiktoken`` file; its path is a parameter. The driver reads it and broadcasts it: the
vocabulary is of a fixed size, at most ``MAX_VOCABULARY`` tokens. Each match of the pattern is encoded separately; a match that is
a token by itself is that token.

Defined results: a null or empty text has no tokens, a null list of ids decodes to nothing; bytes that are not UTF-8 count as U+FFFD; an id that is not in the table stops the
job. Result columns replace input columns of the same name.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cif_lake.llm.common import SLICE, arrow_function, table, with_columns_from_text

MAX_VOCABULARY = 1 << 20
#: Pieces and pairs of tokens that a task remembers at most.
CACHED_PIECES, CACHED_PAIRS = 150_000, 100_000
#: The public pattern for texts whose characters beyond ASCII are all letters; the standard module is quicker than ``regex``.
_LETTERS_ONLY = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z\x80-\U0010FFFF]+| ?[0-9]+| ?[\x00-\x08\x0E-\x1F!-/:-@\[-`{-\x7F]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file by rank."""
    with open(path, "rb") as lines:
        pairs = [(int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, lines)]
    tokens = [b""] * (max(r for r, _ in pairs) + 1)
    for rank, token in pairs:
        tokens[rank] = token
    if len(tokens) > MAX_VOCABULARY:
        raise ValueError(f"more than {MAX_VOCABULARY} tokens")
    return tokens


class Ranks:
    """Tokens by rank, with the two parts that each was merged from."""

    def __init__(self, tokens: list[bytes], pattern: str):
        import ahocorasick
        import regex

        self.tokens = tokens
        self.rank = {t: r for r, t in enumerate(tokens) if t}
        self.pattern = regex.compile(pattern)
        self.parts: list[tuple[int, int] | None] = [None] * len(tokens)
        #: Tokens that merges make; others are only ever a whole piece.
        self.made: dict[bytes, int] = {}
        for token, rank in self.rank.items():
            ends = self._merged(token, rank)
            if len(token) > 1 and len(ends) == 2:
                self.parts[rank] = tuple(ends)
            if len(token) == 1 or len(ends) == 2:
                self.made[token] = rank
        #: Finds all tokens that end at each byte.
        self.occurrences = ahocorasick.Automaton()
        for token, rank in self.made.items():
            self.occurrences.add_word(token.decode("latin-1"), rank)
        self.occurrences.make_automaton()
        self.sizes = [*map(len, tokens)]
        self.longest = max(self.sizes)
        self.pairs: dict[int, bool] = {}
        self.cache = _Cache(self)
        self.letters: dict[str, bool] = {}

    def _merged(self, token: bytes, below: int) -> list[int]:
        """The token's bytes after all merges of a lower rank."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get(parts[i] + parts[i + 1], below))
            if self.rank.get(parts[best] + parts[best + 1], below) >= below:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return [self.rank[p] for p in parts]

    def follows(self, left: int, right: int) -> bool:
        """Whether ``right`` may stand behind ``left`` in an encoding."""
        key = left * len(self.tokens) + right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._border_survives(left, right)
        return known

    def _border_survives(self, left: int, right: int) -> bool:
        tokens, rank, parts = self.tokens, self.rank, self.parts
        undone = len(tokens)
        while True:
            merged = rank.get(tokens[left] + tokens[right])
            if merged is not None and merged < undone:
                return False
            if left > right and parts[left] or not parts[right]:
                if not parts[left]:
                    return True
                undone, left = left, parts[left][1]
            else:
                # Of two merges of one rank the one further left comes first.
                undone, right = right + 1, parts[right][0]

    def extend(self, piece: bytes, last: list[int]) -> list[int]:
        """Complete ``last``, the last tokens of the first prefixes of the piece, for all prefixes; in place."""
        pairs, sizes, n, done = self.pairs.get, self.sizes, len(self.tokens), len(last)
        begin = max(0, done + 1 - self.longest)
        for at, token in self.occurrences.iter(piece[begin:].decode("latin-1")):
            at += begin
            if at != done:
                continue
            start = at + 1 - sizes[token]
            if start:
                before = last[start - 1]
                known = pairs(before * n + token)
                if not known and (known is False or not self.follows(before, token)):
                    continue
            last.append(token)
            done += 1
        if done < len(piece):
            raise ValueError("no token for a byte of the text")
        return last

    def walk(self, piece: bytes, last: list[int]) -> tuple[int, ...]:
        """The encoding of a piece from the last tokens of its prefixes."""
        if (whole := self.rank.get(piece)) is not None:
            return (whole,)
        out, end = [], len(piece)
        while end:
            out.append(last[end - 1])
            end -= len(self.tokens[out[-1]])
        return tuple(out[::-1])

    def piece(self, text: str) -> tuple[int, ...]:
        raw = text.encode()
        whole = self.rank.get(raw)
        return (whole,) if whole is not None else self.walk(raw, self.extend(raw, []))

    def split(self, text: str) -> list[str]:
        if not text.isascii():
            for c in set(text):
                known = self.letters.get(c)
                if known is None:
                    known = self.letters[c] = c < "\x80" or unicodedata.category(c)[0] == "L"
                if not known:
                    return self.pattern.findall(text)
        return _LETTERS_ONLY.findall(text)

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.cache.__getitem__, self.split(text))))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def forget(self) -> None:
        """Drop what was remembered: a Python worker lives on after its task."""
        self.pairs.clear()
        self.cache.old.clear()
        self.cache.clear()


class _Cache(dict):
    """Encodings of the pieces seen lately: two generations, so common pieces stay."""

    def __init__(self, ranks: Ranks):
        super().__init__()
        self.ranks, self.old = ranks, {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        found = self.old.get(piece) or self.ranks.piece(piece)
        if len(piece) > 64:
            return found
        if len(self) >= CACHED_PIECES // 2:
            self.old = dict(self)
            self.clear()
        self[piece] = found
        return found


class Encoded:
    """A text with its encoding that follows appends and edits exactly, at the cost of the pieces they touch."""

    def __init__(self, ranks: Ranks, text: str = ""):
        self.ranks, self.text, self.starts, self.last, self.pieces = ranks, "", [], [], []
        self.edit(0, 0, text)

    @property
    def ids(self) -> list[int]:
        return [i for p in self.pieces for i in p]

    def append(self, more: str) -> None:
        self.edit(len(self.text), len(self.text), more)

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace ``text[start:end]``.

        A match of the pattern depends on two characters behind it at most, so matches that end before those stay. The text is split
        again from there up to the first boundary behind the edit that was one before.
        """
        ends = self.starts[1:] + [len(self.text)] if self.starts else []
        kept = sum(e + 2 <= start for e in ends)
        shift = len(new) - (end - start)
        again = {s + shift: k for k, s in enumerate(self.starts) if s >= end}
        text = self.text[:start] + new + self.text[end:]
        at = ends[kept - 1] if kept else 0
        starts, last, pieces, rest = [], [], [], len(self.starts)
        old = (self.text[self.starts[kept] : ends[kept]].encode(), self.last[kept]) if kept < len(self.starts) else (b"", [])
        for match in self.ranks.pattern.finditer(text, at):
            if match.start() >= start + len(new) and match.start() in again:
                rest = again[match.start()]
                break
            raw = match[0].encode()
            # Prefixes that the first touched piece shares with the old one keep their last tokens.
            same = 0
            if not starts:
                while same < min(len(raw), len(old[0])) and raw[same] == old[0][same]:
                    same += 1
            table = self.ranks.extend(raw, list(old[1][:same]) if same else [])
            starts.append(match.start())
            last.append(table)
            pieces.append(self.ranks.walk(raw, table))
        self.starts = self.starts[:kept] + starts + [s + shift for s in self.starts[rest:]]
        self.last = self.last[:kept] + last + self.last[rest:]
        self.pieces = self.pieces[:kept] + pieces + self.pieces[rest:]
        self.text = text


_LOADED: dict = {}


def _ranks(shared) -> Ranks:
    """The tables of a broadcast vocabulary, made once in a Python worker."""
    tokens, pattern = shared.value
    key = hash((tuple(tokens), pattern))
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Ranks(tokens, pattern)
    return _LOADED[key]


class Tokenizer:
    """Encoding and decoding of columns by the ranks of a file."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        self.shared = spark.sparkContext.broadcast((read_ranks(path), pattern))

    def encode(self, documents: DataFrame, text: str = "text", name: str = "ids") -> DataFrame:
        """Documents with the list of ids of the text."""
        shared = self.shared

        def make():
            ranks = _ranks(shared)
            return lambda texts: [(ranks.encode(t.decode(errors="replace")) if t else [],) for t in texts]

        return with_columns_from_text(documents, text, make, f"{name} array<int>", done=lambda: _ranks(shared).forget())

    def round_trip(self, documents: DataFrame, text: str = "text", name: str = "ids", decoded: str = "decoded") -> DataFrame:
        """``encode``, and the bytes that ``decode`` gives for the ids, in one Python worker."""
        shared = self.shared

        def make():
            ranks = _ranks(shared)

            def run(texts):
                for t in texts:
                    ids = ranks.encode(t.decode(errors="replace")) if t else []
                    yield ids, ranks.decode(ids)

            return lambda texts: list(run(texts))

        return with_columns_from_text(documents, text, make, f"{name} array<int>, {decoded} binary", done=lambda: _ranks(shared).forget())

    def decode(self, documents: DataFrame, ids: str = "ids", name: str = "decoded") -> DataFrame:
        """Documents with the bytes that a list of ids stands for."""
        shared = self.shared

        def run(lists: pa.Array) -> pa.Array:
            tokens = shared.value[0]
            parts = (lists.slice(k, SLICE).to_pylist() for k in range(0, len(lists), SLICE))
            return pa.array([b"".join(map(tokens.__getitem__, ids or ())) for part in parts for ids in part], pa.binary())

        return documents.withColumn(name, arrow_function(run, "binary")(ids))


def public_tokenizer(spark: SparkSession, name: str = "byte_bpe_50k.tiktoken") -> Tokenizer:
    """By a rank file of the installed public vocabularies."""
    import public_tokenizers

    return Tokenizer(spark, public_tokenizers.path(name), public_tokenizers.PATTERN)


def op3(spark, sf_dir: str) -> DataFrame:
    """Ids of every document, and what they decode to."""
    tokenizer = public_tokenizer(spark)
    both = tokenizer.round_trip(table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("ids")), text="ids")
    return both.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
