"""Removal of repeated byte strings by distributed prefix doubling.

A byte goes if a string of ``length`` (200) bytes that covers it also starts anywhere else.
Prefix doubling ranks positions by the bytes that follow them: ranks for h bytes at a
position and at the position h farther make the pair that ranks 2h bytes; Spark sorts
the pairs, and a position whose pair is unique cannot repeat and goes.  Ranks are
content hashes, so that equal strings have equal ranks on every executor without a global
renumbering.  Those that only filter are running sums modulo 2^64; those that decide are
64 bits of XXH3 over a whole context, or polynomials modulo a prime in four random bases (124 bits).

Ranking every byte of the corpus would write many times its size.  Three steps keep this
lossless but small:

1. Of the 64-byte strings inside each window of 200 bytes, only that with the smallest hash
   (the leftmost of equals) is an anchor: equal windows choose the same one, and an
   anchor serves about 69 neighbouring windows.  Spark sorts the ranks of the anchors;
   unique ones go (offset 64).
2. An anchor's windows together cover one context.  Contexts that are equal as a whole
   are settled: all their windows repeat; one of them stays as their representative.
   For the rest a pair of ranks covers 128 bytes, to the right and to the left of
   the anchor.  One of the two lies in every window, so anchors for which both are unique go (offset 128).
3. The windows of what remains are ranked one by one, by the pair of ranks of their halves, sorted, and
   unique ones go (offset 200).

Defined results: null text counts as empty; texts shorter than ``length`` bytes keep
everything and still match nothing; overlapping repeats inside one text count; of equal texts
all copies lose their bytes, the first one too; ids that repeat or are null get a number
of their own per row (``uid``); an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import binary_rows, list_rows, pieces, prepare, stage_table, texts_of, utf8, with_uid
from wardline.llm.hashing import mix, prefix, spans, strong_prefix, strong_spans


def _smallest(value: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by doubling."""
    low, have = value, 1
    while have * 2 <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    return np.minimum(low[: len(value) - width + 1], low[width - have:])


def anchors(buf: np.ndarray, off: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(anchor, first window, last window, row) of each anchor, and the running hash sums."""
    seed = _seed(length)
    one = prefix(buf)
    none = np.zeros(0, np.int64)
    if len(buf) < length:
        return none, none, none, none, one
    at = np.arange(len(buf) - seed + 1)
    rank = spans(one, at, at + seed) >> np.uint64(32) << np.uint64(32) | at.astype(np.uint64)
    best = (_smallest(rank, length - seed + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    row = np.searchsorted(off, np.arange(len(best)), "right") - 1
    window = np.flatnonzero(np.arange(len(best)) + length <= off[row + 1])
    if not len(window):
        return none, none, none, none, one
    best, row = best[window], row[window]
    new = np.ones(len(window), bool)
    new[1:] = (best[1:] != best[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(window)) - 1
    return best[first], window[first], window[last], row[first], one


def _seed(length: int) -> int:
    """Bytes of an anchor: less than a third of the window, so that one side always has as many more."""
    return max(1, min(64, length // 3))


def _anchor_rows(docs: DataFrame, length: int) -> DataFrame:
    """(seed, uid, at, context, sides) of every anchor; ``at`` packs position and window range,
    ``sides`` 32 bits of the rank of twice the seed to the right and to the left (0: none)."""
    seed = _seed(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in pieces(batches):
            buf, off = utf8(p.column("text"))
            a, lo, hi, row, one = anchors(buf, off, length)
            start, end = off[row], off[row + 1]
            right = np.where(a + 2 * seed <= end, spans(one, a, np.minimum(a + 2 * seed, len(buf))) >> np.uint64(32) | np.uint64(1), 0)
            left = np.where(a - seed >= start, spans(one, np.maximum(a - seed, 0), a + seed) >> np.uint64(32) | np.uint64(1), 0)
            raw = buf.tobytes()
            around = np.array([xxhash.xxh3_64_intdigest(raw[x:z]) for x, z in zip(lo.tolist(), (hi + length).tolist(), strict=True)], np.uint64)
            around = mix(around ^ ((a - lo) << 32 | (hi - lo)).astype(np.uint64))
            cols = [spans(one, a, a + seed).view(np.int64), p.column("uid").to_numpy()[row],
                    (a - start) << 24 | (a - lo) << 12 | (a - hi), around.view(np.int64),
                    (right.astype(np.uint64) << np.uint64(32) | left.astype(np.uint64)).view(np.int64)]
            for k in range(0, len(a), 20_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[k:k + 20_000]) for c in cols], ["seed", "uid", "at", "context", "sides"])

    return docs.select("uid", "text").mapInArrow(run, "seed long, uid long, at long, context long, sides long")


def _single_windows(docs: DataFrame, open_: DataFrame, length: int) -> DataFrame:
    """(x, y, uid, p): the pair of ranks of the halves of each window of the open anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in pieces(batches):
            buf, off = utf8(p.column("text"))
            at = p.column("at")
            row = np.repeat(np.arange(p.num_rows), np.diff(at.offsets.to_numpy()))
            at = at.flatten().to_numpy()
            pos = off[row] + (at >> 24)
            step = np.zeros(len(buf) + 1, np.int64)
            np.add.at(step, pos - (at >> 12 & 0xFFF), 1)
            np.add.at(step, pos - (at & 0xFFF) + 1, -1)
            w = np.flatnonzero(np.cumsum(step)[:-1] > 0)
            row = np.searchsorted(off, w, "right") - 1
            half = length // 2
            one, two = (strong_prefix(buf, k) for k in (0, 1))
            cols = [strong_spans(one, w, w + half).view(np.int64), strong_spans(two, w + half, w + length).view(np.int64),
                    p.column("uid").to_numpy()[row], w - off[row]]
            for k in range(0, len(w), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[k:k + 50_000]) for c in cols], ["x", "y", "uid", "p"])

    per_text = open_.groupBy("uid").agg(F.collect_list("at").alias("at"))  # anchors of one text
    return docs.join(per_text, "uid").select("uid", "text", "at").mapInArrow(run, "x long, y long, uid long, p long")


def _repeats(frame: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows whose keys another row has too: neighbours in the sorted order, so no group is held."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return (frame.withColumns({"before_": F.lag(order[-1]).over(w), "after_": F.lead(order[-1]).over(w)})
            .filter(F.col("before_").isNotNull() | F.col("after_").isNotNull()).drop("before_", "after_"))


def repeated_windows(docs: DataFrame, length: int = 200) -> DataFrame:
    """(uid, lo, hi): ranges of starts of strings of ``length`` bytes that also start elsewhere.
    ``docs`` has (uid, text) without nulls."""
    w = Window.partitionBy("seed").orderBy("context", "uid", "at")
    rows = _repeats(_anchor_rows(docs, length), ["seed"], ["context", "uid", "at"])
    rows = rows.withColumns({"before": F.lag("context").over(w), "after": F.lead("context").over(w)})
    rows = stage_table(rows.select(
        "seed", "uid", "at", "sides",
        F.coalesce(F.col("before") == F.col("context"), F.lit(False)).alias("again"),
        F.coalesce(F.col("after") == F.col("context"), F.lit(False)).alias("more")), "anchors")
    settled = rows.filter("again or more").select("uid", *_range("at"))
    sides = rows.filter("not again").select(
        "seed", "uid", "at", F.explode(F.array(F.shiftrightunsigned("sides", 32), -F.col("sides").bitwiseAND(F.lit(0xFFFFFFFF)))).alias("side"))
    open_ = _repeats(sides.filter("side != 0"), ["seed", "side"], ["uid", "at"]).select("uid", "at").distinct()
    single = _repeats(_single_windows(docs, open_, length), ["x", "y"], ["uid", "p"])
    return stage_table(settled.union(single.select("uid", F.col("p").alias("lo"), F.col("p").alias("hi"))), "ranges")


def _range(at: str):
    pos = F.shiftright(at, 24)
    return [(pos - F.shiftright(at, 12).bitwiseAND(F.lit(0xFFF))).alias("lo"), (pos - F.col(at).bitwiseAND(F.lit(0xFFF))).alias("hi")]


def remove_repeats(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, uid, n_bytes, spans, kept): removed runs as alternating starts and ends, and the bytes left."""
    if not 4 <= length <= 4000:
        raise ValueError("length must be from 4 to 4000 bytes")
    prepare(docs.sparkSession)
    docs = texts_of(with_uid(docs.select(id_col, text_col), id_col), id_col, "uid", text_col=text_col)
    found = repeated_windows(docs, length)
    per_text = found.groupBy("uid").agg(F.collect_list(F.col("lo") * F.lit(1 << 32) + F.col("hi")).alias("ranges"))  # of one text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in pieces(batches):
            buf, off = utf8(p.column("text"))
            ranges = p.column("ranges").fill_null([])
            row = np.repeat(np.arange(p.num_rows), np.diff(ranges.offsets.to_numpy()))
            ranges = ranges.flatten().to_numpy()
            step = np.zeros(len(buf) + 1, np.int64)
            np.add.at(step, off[row] + (ranges >> 32), 1)
            np.add.at(step, off[row] + (ranges & 0xFFFFFFFF) + length, -1)
            out = np.cumsum(step)[:-1] > 0
            edge = np.diff(np.concatenate([[0], out.astype(np.int8), [0]]))
            inner = off[1:-1][(off[1:-1] > 0) & (off[1:-1] < len(buf))]
            inner = np.unique(inner[out[inner] & out[inner - 1]])  # a run ends and another begins at a text's border
            start = np.sort(np.concatenate([np.flatnonzero(edge == 1), inner]))
            end = np.sort(np.concatenate([np.flatnonzero(edge == -1), inner]))
            own = np.searchsorted(off, start, "right") - 1
            both = np.stack([start - off[own], end - off[own]], 1).reshape(-1)
            kept = np.append(0, np.cumsum(~out))[off]
            yield pa.RecordBatch.from_arrays(
                [*p.columns[:2], pa.array(np.diff(off)), list_rows(pa.array(both), 2 * np.searchsorted(own, np.arange(p.num_rows + 1))),
                 binary_rows(buf[~out], kept)], [id_col, "uid", "n_bytes", "spans", "kept"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.join(per_text, "uid", "left").select(id_col, "uid", "text", "ranges")
            .mapInArrow(run, f"`{id_col}` {kind}, uid long, n_bytes long, spans array<long>, kept binary"))
