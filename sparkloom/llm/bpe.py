"""Byte-level BPE by a table of each prefix's last token, and its way back."""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import Aside, few, short_batches, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Distinct pieces whose ids a worker remembers; with as many new ones again, those not met since are forgotten.
REMEMBERED = 250_000
#: Characters of the longest piece that is remembered, so that what is remembered is bounded in bytes too.
LONGEST = 64
#: Pairs of tokens for which a worker remembers whether one may follow the other.
PAIRS = 500_000
#: A match looks at most this many characters beyond its end: the longest contraction, and one more.
LOOKS_AHEAD = 3
NEVER = 1 << 60


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Coder:
    """Encodes pieces of bytes. The last token of a prefix is unique, and what it leaves is a shorter prefix.

    A token may follow another if no merge crosses their border: none whose rank comes before both halves
    are merged away from the border. Of the tokens that end a prefix, one alone may follow the last token
    of what it leaves, so a table of last tokens is filled from left to right and never changed.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {v: k for k, v in ranks.items()}
        #: Every beginning of a token, with the token's id if it is one.
        self.beginnings = {k[:n]: -1 for k in ranks for n in range(1, len(k))} | ranks
        self.longest = max(map(len, ranks), default=0)
        self._halves: dict[bytes, tuple[bytes, bytes] | None] = {}
        self._edges: dict[tuple[bytes, int], list[tuple[bytes, int]]] = {}
        self._pairs: dict[int, bool] = {}

    def halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two parts that are merged last in token; None for one byte, and for what no merges make."""
        if token not in self._halves:
            parts = [token[i : i + 1] for i in range(len(token))]
            while len(parts) > 2:
                rank, i = min((self.ranks.get(parts[i] + parts[i + 1], NEVER), i) for i in range(len(parts) - 1))
                if rank == NEVER:
                    break
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            self._halves[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self._halves[token]

    def made(self, token: bytes) -> bool:
        return len(token) == 1 or self.halves(token) is not None

    def edge(self, token: bytes, side: int) -> list[tuple[bytes, int]]:
        """The tokens that stand at a side of token while it is merged, each with the rank that ends it."""
        key = (token, side)
        if key not in self._edges:
            found, until, at = [], NEVER, token
            while True:
                found.append((at, until))
                parts = self.halves(at) if len(at) > 1 else None
                if parts is None:
                    break
                until, at = self.ranks[at], parts[side]
            self._edges[key] = found
        return self._edges[key]

    def may_follow(self, a: int, b: int) -> bool:
        known = self._pairs.get(a << 32 | b)
        if known is None:
            if len(self._pairs) > PAIRS:
                self._pairs.clear()
            known = self._pairs[a << 32 | b] = self._apart(self.edge(self.bytes_of[a], 1), self.edge(self.bytes_of[b], 0))
        return known

    def _apart(self, left: list[tuple[bytes, int]], right: list[tuple[bytes, int]]) -> bool:
        """Whether no merge crosses the border. Of equal ranks the leftmost goes first, so the border loses to a merge on its left and wins on its right."""
        rank = self.ranks.get
        for x, x_ends in left:
            for y, y_ends in right:
                r = rank(x + y, NEVER)
                if r < x_ends and r <= y_ends:
                    return False
        return True

    def fill(self, piece: bytes, last: list[int], start: int = 0) -> list[int]:
        """last[i] is the id of the last token of piece[:i]; the entries up to start are there already.

        Tokens are tried from each position in turn, and only those that reach beyond the entries filled so
        far: all beginnings of a token are known, so what is too long to begin one rules out all longer ones.
        """
        n = len(piece)
        del last[start + 1 :]
        last += [-1] * (n + 1 - len(last))
        begins, pairs = self.beginnings.get, self._pairs.get
        open_ = start + 1  # the shortest prefix without an entry
        for i in range(max(0, start - self.longest) if start else 0, n):
            before = last[i]
            for j in range(open_, n + 1):
                s = piece[i:j]
                token = begins(s)
                if token is None:
                    break
                if token < 0 or last[j] >= 0:
                    continue
                if i:
                    follows = pairs(before << 32 | token)
                    if self.may_follow(before, token) if follows is None else follows:
                        last[j] = token
                elif self.made(s):
                    last[j] = token
            while open_ <= n and last[open_] >= 0:
                open_ += 1
            if open_ > n:
                break
        return last

    def walk(self, last: list[int]) -> list[int]:
        ids, i = [], len(last) - 1
        while i > 0:
            ids.append(last[i])
            i -= len(self.bytes_of[last[i]])
        return ids[::-1]

    def encode_piece(self, piece: bytes) -> list[int]:
        """The ids of a piece. A piece that is a token is that token, whatever merges would make of it."""
        token = self.ranks.get(piece)
        return [token] if token is not None else self.walk(self.fill(piece, [-1]))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class Growing:
    """A piece that changes: append() and replace() fill only the part of its table behind the change."""

    def __init__(self, coder: Coder, piece: bytes = b""):
        self.coder, self.piece, self.last = coder, b"", [-1]
        self.append(piece)

    def append(self, more: bytes) -> None:
        self.replace(len(self.piece), len(self.piece), more)

    def replace(self, start: int, end: int, new: bytes) -> None:
        """Bytes start to end become new."""
        self.piece = self.piece[:start] + new + self.piece[end:]
        self.coder.fill(self.piece, self.last, start)

    def ids(self) -> list[int]:
        token = self.coder.ranks.get(self.piece)
        return [token] if token is not None else self.coder.walk(self.last)


def compiled(pattern: str):
    """The pattern with white space as Unicode's property has it."""
    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


class _Remembered(dict):
    """Pieces and their packed ids. A piece that is not there is looked up among the older ones, or encoded."""

    def __init__(self, coder: Coder, older: dict[str, bytes]):
        super().__init__()
        self.coder, self.older = coder, older

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            tokens = self.coder.encode_piece(piece.encode())
            ids = struct.pack(f"<{len(tokens)}I", *tokens)
        if len(piece) <= LONGEST:
            self[piece] = ids
        return ids


class TextCoder:
    """Encodes texts, each match of the pattern for itself."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN):
        self.coder, self.match = Coder(ranks), compiled(pattern)
        self.known = _Remembered(self.coder, {})

    def packed(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if len(self.known) > REMEMBERED:
            self.known = _Remembered(self.coder, dict(self.known))
        return b"".join(map(self.known.__getitem__, self.match.findall(text)))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), "<u4").tolist()

    def pieces(self, text: str) -> list[tuple[int, int]]:
        return [m.span() for m in self.match.finditer(text)]

    def edited(self, text: str, pieces: list[tuple[int, int]], start: int, end: int, new: str) -> tuple[str, list[tuple[int, int]]]:
        """The text with characters start to end replaced, and its pieces: only those near the edit are matched again."""
        after, moved = text[:start] + new + text[end:], len(new) - (end - start)
        kept = [p for p in pieces if p[1] + LOOKS_AHEAD <= start]
        old = {p[0] + moved: k for k, p in enumerate(pieces) if p[0] >= end}
        at, found = kept[-1][1] if kept else 0, []
        while at < len(after):
            if at in old and at >= start + len(new):
                found += [(a + moved, b + moved) for a, b in pieces[old[at] :]]
                break
            found.append(self.match.match(after, at).span())
            at = found[-1][1]
        return after, kept + found


_CODERS: dict[str, TextCoder] = {}


def _coder(name: str, ranks, pattern: str) -> TextCoder:
    """The coder of that name, kept with what it remembers while the worker lives; one at a time."""
    if name not in _CODERS:
        _CODERS.clear()
        _CODERS[name] = TextCoder(ranks.value, pattern)
    return _CODERS[name]


def _coded(df: DataFrame, given: str, added: str, work: Callable[[TextCoder, list], dict], ranks: dict[bytes, int], pattern: str, back: bool = True) -> DataFrame:
    """df with the columns that work makes of the one named given, which is left out unless it comes back.

    The vocabulary, a file of fixed size, is broadcast, for executors may not have it. What Spark hands to a
    worker at a time is many whole rows, so each column goes there once, and nothing returns that is not wanted.
    """
    short_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(ranks)
    new = df.sparkSession.createDataFrame([], added).schema
    kept = Aside(df)
    at = kept.at(given)
    returned = [k for k in range(len(kept.own)) if back or k != at]
    made = StructType([kept.df.schema.fields[k] for k in returned] + new.fields)
    name = hashlib.sha256(repr((pattern, sorted(ranks.items()))).encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        coder, out = _coder(name, shared, pattern), to_arrow_schema(made)
        for batch in few(batches):
            got = work(coder, batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in returned], *[pa.array(got[f.name], out.field(f.name).type) for f in new]], schema=out)

    taken = {n.lower() for n in new.names}
    rest = [F.col(kept.own[k]).alias(kept.names[k]) for k in returned if kept.names[k].lower() not in taken]
    return kept.df.mapInArrow(run, made).select(*rest, *new.names)


def encode(df: DataFrame, *, text: str = "text", ranks: dict[bytes, int] | None = None, pattern: str = public_tokenizers.PATTERN, texts: bool = True) -> DataFrame:
    """df, without its text column if texts is false, with n_tokens, ids, the tokens as little-endian unsigned 32-bit integers, and decoded_sha256 of what they decode to.

    A null or empty text has no tokens, a long one costs its length. Columns of df under one of these names
    are replaced; other names cannot clash. Rows stay as they are, repeated ones too, an empty table gives an
    empty result, and there is no exchange. A worker holds the vocabulary, some texts and twice REMEMBERED
    pieces at most.
    """
    ranks = ranks or read_ranks(public_tokenizers.path(VOCABULARY))

    def work(coder: TextCoder, texts: list) -> dict:
        ids = [coder.packed(t or "") for t in texts]
        back = [hashlib.sha256(coder.coder.decode(np.frombuffer(x, "<u4").tolist())).hexdigest() for x in ids]
        return {"n_tokens": [len(x) // 4 for x in ids], "ids": ids, "decoded_sha256": back}

    return _coded(df, text, "n_tokens bigint, ids binary, decoded_sha256 string", work, ranks, pattern, texts)


def decode(df: DataFrame, *, ids: str = "ids", ranks: dict[bytes, int] | None = None) -> DataFrame:
    """df with decoded, the bytes of its ids. Null ids give no bytes; a column of df named decoded is replaced, other names cannot clash.

    Repeated rows stay, long values cost their length, and an empty table gives an empty result.
    """
    ranks = ranks or read_ranks(public_tokenizers.path(VOCABULARY))

    def work(coder: TextCoder, given: list) -> dict:
        return {"decoded": [coder.coder.decode(np.frombuffer(x or b"", "<u4").tolist()) for x in given]}

    return _coded(df, ids, "decoded binary", work, ranks, public_tokenizers.PATTERN)


def op7_byte_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, texts=False).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), "decoded_sha256")
