"""Byte-level BPE encoding and decoding.

Encoding never merges step by step.  The bytes of a piece are read as Latin-1
characters, one Aho-Corasick pass finds the longest vocabulary entry starting at
each byte, and the encoder takes longest entries first and steps back to shorter
ones until every two neighbours are compatible: two tokens may stand side by side
only if the merges of their joined bytes give back exactly these two.  The unique
sequence of pairwise compatible tokens is the one that the merges give.  Answers to
"may a stand before b" are kept in a table, and a position that failed is not tried
again, so the time is linear in the piece.

Both directions are one pass without a shuffle.  The vocabulary (one file of ranks)
is read by the driver and broadcast: its size is that of the file.

Defined results: null text encodes like an empty one, to no ids; null ids decode to
no bytes; an id outside the vocabulary fails; ids of any prior special token are
never made (its letters are ordinary text); repeated rows give repeated rows; an
empty table gives an empty result.  Rows carry the named columns only.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import binary_rows, list_rows, pieces, prepare, texts_of, utf8

#: Unicode White_Space, as fixed values (regular expressions of Python also count U+001C to U+001F).
WHITE_SPACE = "\t-\r \x85\xa0  -     　"
_CACHE_ROWS = 300_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a ``.tiktoken`` file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Vocabulary:
    """Ranks, the merge that makes each token, and the automaton of all tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        self.finder = ahocorasick.Automaton()
        for t, i in ranks.items():
            self.finder.add_word(t.decode("latin-1"), (len(t), i))
        self.finder.make_automaton()
        self.size = {i: len(t) for t, i in ranks.items()}
        self.shorter = {i: next((ranks[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in ranks), None)
                        for t, i in ranks.items()}
        self.halves: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        for i in sorted(self.token):
            self.halves[i] = (i, i)
            t, left = self.token[i], self.shorter[i]
            while left is not None:
                right = ranks.get(t[self.size[left]:])
                if right is not None and max(left, right) < i and self._compatible(left, right):
                    self.halves[i] = (left, right)
                    self.joined[left, right] = i
                    break
                left = self.shorter[left]

    def _compatible(self, a: int, b: int) -> bool:
        """No merge across the border comes before the merges that made both sides.

        Both tokens are taken apart again from the last merge backwards; ``bound`` is
        the rank that a merge across the border must not undercut at that moment.
        """
        bound = float("inf")
        while True:
            if self.joined.get((a, b), bound) < bound:
                return False
            can_a, can_b = self.halves[a][1] != a, self.halves[b][0] != b
            if can_a and (a > b or not can_b):
                bound, a = a, self.halves[a][1]
            elif can_b:
                bound, b = b + 1, self.halves[b][0]
            else:
                return True

    def compatible(self, a: int, b: int) -> bool:
        known = self.fits.get((a, b))
        if known is None:
            if len(self.fits) > 500_000:
                self.fits.clear()
            known = self.fits[a, b] = self._compatible(a, b)
        return known

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one piece, as the merges would give them."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        n = len(piece)
        longest: list[int | None] = [None] * n
        for end, (size, i) in self.finder.iter(piece.decode("latin-1")):
            longest[end - size + 1] = i
        open_at = [True] * (n + 1)
        out: list[int] = []
        at, token = 0, longest[0] if n else None
        while at < n:
            before = out[-1] if out else None
            while token is not None:
                end = at + self.size[token]
                if open_at[end] and (before is None or self.compatible(before, token)):
                    break
                token = self.shorter[token]
            if token is not None:
                out.append(token)
                at = end
                token = longest[at] if at < n else None
            else:
                if before is None:
                    raise ValueError("the vocabulary lacks single bytes of the text")
                open_at[at] = False
                at -= self.size[out.pop()]
                token = before
        return out


def _classes(pattern: str, high: bool) -> str:
    """The pattern for Python's ``re``: properties written as ranges of characters."""
    top = 0x110000 if high else 0x10000
    letters = "".join(chr(c) for c in range(top) if not 0xD800 <= c < 0xE000)

    def ranges(prop: str) -> str:
        return "".join(f"\\U{ord(m[0][0]):08x}-\\U{ord(m[0][-1]):08x}" for r in regex.findall(prop + "+", letters)
                       for m in _consecutive(r))

    known = {r"\p{L}": ranges(r"\p{L}"), r"\p{N}": ranges(r"\p{N}"), r"\s": WHITE_SPACE}
    out, at, inside = "", 0, False
    while at < len(pattern):
        name = next((k for k in (*known, r"\S") if pattern.startswith(k, at)), None)
        if name == r"\S":
            out += f"[^{WHITE_SPACE}]"
        elif name:
            out += known[name] if inside else f"[{known[name]}]"
        else:
            inside = {"[": True, "]": False}.get(pattern[at], inside)
            out += pattern[at]
        at += len(name or " ")
    return out


def _consecutive(text: str) -> Iterator[tuple[str]]:
    start = 0
    for k in range(1, len(text) + 1):
        if k == len(text) or ord(text[k]) != ord(text[k - 1]) + 1:
            yield (text[start:k],)
            start = k


class Encoder(dict):
    """Packed ids of each piece seen before; unseen pieces are encoded on first use."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.vocabulary = Vocabulary(ranks)
        self.split_low = re.compile(_classes(pattern, False)).findall
        self.split_all = regex.compile(pattern.replace(r"[^\s", "[^" + WHITE_SPACE).replace(r"\s", f"[{WHITE_SPACE}]")
                                       .replace(r"\S", f"[^{WHITE_SPACE}]"), regex.V0).findall

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.vocabulary.encode(piece.encode("utf-8")), np.int32).tobytes()
        if len(piece) <= 64:
            if len(self) >= _CACHE_ROWS:
                self.clear()
            self[piece] = ids
        return ids

    def __call__(self, text: str, low: bool) -> bytes:
        return b"".join(map(self.__getitem__, (self.split_low if low else self.split_all)(text)))


_made: dict = {}


def _encoder(shared, pattern: str) -> Encoder:
    key = ("encoder", shared.value[0], pattern)
    if key not in _made:
        _made[key] = Encoder(shared.value[1], pattern)
    return _made[key]


def _shared_ranks(df: DataFrame, path: str):
    return df.sparkSession.sparkContext.broadcast((path, read_ranks(path)))


def encode(docs: DataFrame, path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text",
           decoded: bool = False) -> DataFrame:
    """``keep`` columns and ``ids`` (array of int) of each whole text; with ``decoded`` also the
    bytes that these ids decode to, in the same pass.

    ``path`` is a rank file that the driver can read; ``pattern`` splits the text before
    the merges, and may use \\p{L}, \\p{N}, \\s and \\S.
    """
    rows = texts_of(docs, *keep, text_col=text_col)
    shared = _shared_ranks(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for p in pieces(batches):
            encoder = encoder or _encoder(shared, pattern)
            buf, off = utf8(p.column("text"))
            high = np.add.reduceat(np.append(buf >= 0xF0, False), np.minimum(off[:-1], len(buf))) if len(buf) else off[:-1]
            high = np.where(np.diff(off) > 0, high, 0)
            parts = [encoder(t, not h) for t, h in zip(p.column("text").to_pylist(), high.tolist(), strict=True)]
            ends = np.cumsum([0, *map(len, parts)]) // 4
            ids = np.frombuffer(b"".join(parts), np.int32)
            back = [_bytes(ids, ends, encoder.vocabulary.token)] if decoded else []
            yield pa.RecordBatch.from_arrays([*p.columns[:-1], list_rows(pa.array(ids), ends), *back],
                                             [*keep, "ids", "decoded"][: len(keep) + 1 + len(back)])

    prepare(docs.sparkSession)
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema[:-1])
    return rows.mapInArrow(run, schema + "ids array<int>" + ", decoded binary" * decoded)


def _bytes(ids: np.ndarray, ends: np.ndarray, token: dict[int, bytes]) -> pa.Array:
    parts = [b"".join(map(token.__getitem__, ids[a:b].tolist())) for a, b in zip(ends[:-1], ends[1:], strict=True)]
    return binary_rows(np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)]))


def decode(rows: DataFrame, path: str, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """The rows with the bytes of their ids (binary: single ids may be parts of a character)."""
    shared = _shared_ranks(rows, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = ("decoder", shared.value[0])
        if key not in _made:
            _made[key] = {i: t for t, i in shared.value[1].items()}
        token = _made[key]
        for b in batches:
            column = b.column(ids_col).fill_null([]) if b.column(ids_col).null_count else b.column(ids_col)
            off = column.offsets.to_numpy().astype(np.int64)
            ids = column.values.to_numpy(zero_copy_only=False)
            for start in range(0, b.num_rows, 200):
                out = b.slice(start, 200)
                yield pa.RecordBatch.from_arrays([*out.columns, _bytes(ids, off[start:start + 201], token)], [*out.schema.names, name])

    prepare(rows.sparkSession)
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema)
    return rows.mapInArrow(run, f"{schema}`{name}` binary")


def digests(decoded: DataFrame, *more: str) -> DataFrame:
    """n_tokens and the SHA-256 of the decimal ids and of the decoded bytes, after the columns ``more``."""
    return decoded.select(
        *more, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
