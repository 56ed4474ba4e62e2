"""Token ids packed into rows of fixed length, with cumulative segment lengths and resets.

A text longer than a row is split without loss: all full rows of it stand alone, and its
last part is packed like a short text.  Parts are placed by best-fit decreasing: longest
first, each into the row with the least room that still holds it.  A segment tree over the
possible capacities finds that row in logarithmic time.

Texts are dealt once, by a hash of their number, into shards of about ``shard_bytes`` of text;
a shard is packed by itself, so the rows depend on the texts only and not on the
partitions, and a task holds the unfinished rows of one shard.

Defined results: null and empty texts have no tokens and stand in no row; repeated rows are
packed one by one; equal lengths are ordered by (uid, start); null ids are carried as
null in ``doc_ids``, with ``uids`` telling the rows apart; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.bpe import read_ranks
from wardline.llm.common import pieces, prepare, texts_of, with_uid

SCHEMA = ("shard long, row long, n_tokens int, tokens binary, cu_seqlens array<int>, resets array<int>, "
          "doc_ids array<long>, uids array<long>, starts array<long>")


class Capacities:
    """Segment tree over capacities 0..most: which are held by some open row."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.some = bytearray(2 * self.leaves)
        self.rows: dict[int, list[int]] = {}

    def put(self, capacity: int, row: int) -> None:
        self.rows.setdefault(capacity, []).append(row)
        at = self.leaves + capacity
        while at and not self.some[at]:
            self.some[at] = 1
            at >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """(capacity, row) of the open row with the smallest capacity >= least."""
        at = self.leaves + least
        if not self.some[at]:
            while at & 1 or not self.some[at ^ 1]:  # up, to a parent whose right side is held
                at >>= 1
                if at <= 1:
                    return None
            at ^= 1
            while at < self.leaves:
                at = 2 * at if self.some[2 * at] else 2 * at + 1
        capacity = at - self.leaves
        rows = self.rows[capacity]
        row = rows.pop()
        if not rows:
            self.some[at] = 0
            while at > 1 and not self.some[at ^ 1]:
                at >>= 1
                self.some[at] = 0
        return capacity, row


def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Rows of item numbers; items are taken from the longest to the shortest."""
    rows: list[list[int]] = []
    open_ = Capacities(size)
    for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        found = open_.take(lengths[k])
        capacity, row = found if found else (size, len(rows))
        if not found:
            rows.append([])
        rows[row].append(k)
        if capacity > lengths[k]:
            open_.put(capacity - lengths[k], row)
    return rows


def pack(docs: DataFrame, path: str, pattern: str, size: int = 2048, pad: int | None = None, id_col: str = "doc_id",
         text_col: str = "text", shard_bytes: int = 4 << 20) -> DataFrame:
    """Packed rows (``SCHEMA``) of the ids of all texts.

    ``tokens`` are ``size`` little-endian ids (2 bytes each for vocabularies up to 65,536, else 4),
    filled up with ``pad`` (the first id beyond the ranks).  Segment i of a row lies at
    ``cu_seqlens[i]:cu_seqlens[i+1]`` and holds the ids of text ``uids[i]`` from ``starts[i]`` on;
    positions count from 0 again at each of ``resets`` (segments, and the padding if any).
    """
    prepare(docs.sparkSession)
    ranks = read_ranks(path)
    pad = max(ranks.values()) + 1 if pad is None else pad
    shared = docs.sparkSession.sparkContext.broadcast(ranks)  # as large as the vocabulary file
    rows = texts_of(with_uid(docs.select(id_col, text_col), id_col), id_col, "uid", text_col=text_col)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    parts = max(1, -(-total // (8 * shard_bytes)))
    kind = np.dtype("<u2") if max(pad, *ranks.values()) < 65_536 else np.dtype("<u4")
    dealt = (rows.withColumn("shard", F.pmod(F.xxhash64("uid"), F.lit(shards)))
             .repartition(parts, "shard").sortWithinPartitions("shard", "uid"))

    def row_of(shard: int, number: int, parts: list[tuple]) -> tuple:
        ids = np.concatenate([p[3] for p in parts])
        ends = np.cumsum([0, *[len(p[3]) for p in parts]]).tolist()
        out = np.full(size, pad, kind)
        out[: len(ids)] = ids
        resets = ends[:-1] + ends[-1:] * (ends[-1] < size)
        return (shard, number, len(ids), out.tobytes(), ends, resets, [p[0] for p in parts], [p[1] for p in parts], [p[2] for p in parts])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=shared.value, special_tokens={})
        now, number, tails, out = None, 0, [], []

        def finish() -> list[tuple]:
            return [row_of(now, number + k, [tails[i] for i in items])
                    for k, items in enumerate(best_fit([len(t[3]) for t in tails], size))]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), *[pa.list_(t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64())]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                                              [c.split()[0] for c in SCHEMA.split(", ")])

        for p in pieces(batches):
            for doc, uid, text, shard in zip(*[p.column(c).to_pylist() for c in (id_col, "uid", "text", "shard")], strict=True):
                if shard != now:
                    out += finish()
                    now, number, tails = shard, 0, []
                ids = np.asarray(encoding.encode_to_numpy(text, disallowed_special=()), kind)
                for start in range(0, len(ids), size):
                    part = (doc, uid, start, ids[start:start + size])
                    if len(part[3]) == size:
                        out.append(row_of(now, number, [part]))
                        number += 1
                    else:
                        tails.append(part)
                if len(out) >= 200:
                    yield batch(out)
                    out = []
        out += finish()
        for k in range(0, len(out), 200):
            yield batch(out[k:k + 200])

    return dealt.mapInArrow(run, SCHEMA)


def write_packed(packed: DataFrame, path: str) -> None:
    """Write the rows as Parquet: one matrix row, its segment bounds and its resets per record."""
    packed.write.mode("errorifexists").parquet(path)
