"""Line dedup: an exact set-similarity join over the lines of all documents.

A line is the set of its five-word shingles.  Tokens are ordered from rare to
frequent by one global table (occurrences per hash bucket; ``buckets`` bounds its
size, and any total order gives the same result), so that lines with a Jaccard
likeness of t or more share a token among the first ``n - ceil(t n) + 1`` of each.
Tokens of these prefixes are joined under a length filter and a positional filter,
candidates are verified on whole sets, and a line goes if an earlier line (by uid,
line number) is equal or alike.

Equal lines form a class and are compared once.  In each token group every class is
first compared with the earliest class of the group; classes that found no earlier
match then meet all other earlier classes of their groups.  Classes that are already
known to go need no further test, which keeps groups of n alike lines at n tests.

Defined results: words are runs of bytes that are no ASCII white space, case counts; a
line of one to four words is one shingle; lines without words are always kept; null
text counts as empty and has one line; documents keep their remaining lines in order;
repeated rows follow each other by uid, so all but the first lose their lines; ids that
repeat or are null get numbers of their own (``uid``); an empty table gives an empty
result; columns other than ``keep`` are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import binary_rows, list_rows, pieces, prepare, stage_table, texts_of, utf8, with_uid
from wardline.llm.hashing import shingles, sorted_sets, words
from wardline.llm.overlap import identity, verify

_SEEN_CLASSES = 200_000


def line_tokens(p: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(shingle, segment) of a batch, and (row, line number) of each segment."""
    buf, off = utf8(p.column("text"))
    breaks = np.flatnonzero(buf == 10)
    row = np.concatenate([np.arange(p.num_rows), np.searchsorted(off, breaks, "right") - 1])
    start = np.concatenate([off[:-1], breaks + 1])
    order = np.lexsort((start, row))
    row, start = row[order], start[order]
    line = np.arange(len(row)) - np.searchsorted(row, row)
    h, seg = shingles(*words(buf, np.append(start, len(buf))), size)
    return h, seg, row, line


def rarity(texts: DataFrame, size: int, buckets: int, slices: int = 16) -> np.ndarray:
    """Occurrences of tokens per hash bucket: one array of ``buckets`` numbers.

    Tasks count for themselves and send their counts in ``slices`` pieces, which are added
    up in groups of tasks and then over the groups."""
    width = buckets // slices

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held = np.zeros(buckets, np.int64), []
        for p in pieces(batches):
            held.append((line_tokens(p, size)[0] % np.uint64(buckets)).astype(np.int32))
            if sum(map(len, held)) > buckets:
                total += np.bincount(np.concatenate(held), minlength=buckets)
                held = []
        total += np.bincount(np.concatenate([np.zeros(0, np.int32), *held]), minlength=buckets)
        for k in range(slices):
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([total[k * width:(k + 1) * width].tobytes()])], ["slice", "n"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.zeros(width, np.int64)
        for b in batches:
            for k, n in zip(b.column("slice").to_pylist(), b.column("n").to_pylist(), strict=True):
                if k != now and now is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([total.tobytes()])], ["slice", "n"])
                    total = np.zeros(width, np.int64)
                now = k
                total += np.frombuffer(n, np.int64)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([total.tobytes()])], ["slice", "n"])

    schema = "slice int, n binary"
    own = texts.select("text").mapInArrow(count, schema).withColumn("team", F.spark_partition_id() % 64)
    teams = own.repartition("slice", "team").sortWithinPartitions("slice").select("slice", "n").mapInArrow(add, schema)
    rows = teams.repartition(slices, "slice").sortWithinPartitions("slice").mapInArrow(add, schema).collect()  # buckets numbers
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r.slice * width:(r.slice + 1) * width] = np.frombuffer(r.n, np.int64)
    return out


def rare_first(h: np.ndarray, seg: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Order by (segment, count, hash), counts beyond 65,535 being equal."""
    count = np.minimum(count, 65_535).astype(np.uint64)
    if len(seg) and seg[-1] < 65_536:
        key = seg.astype(np.uint64) << np.uint64(48) | count << np.uint64(32) | h >> np.uint64(32)
        order = np.argsort(key)
        k, x = key[order], h[order]
        if not ((k[1:] == k[:-1]) & (x[1:] != x[:-1])).any():
            return order
    return np.lexsort((h, count, seg))


def prefix_length(n: np.ndarray, threshold: float) -> np.ndarray:
    return n - np.ceil(threshold * n - 1e-9).astype(np.int64) + 1


def line_classes(texts: DataFrame, counts: np.ndarray, size: int, threshold: float) -> DataFrame:
    """(uid, line, c1, c2, n, prefix) of each line with words.  The prefix stands only
    where a task meets a class for the first time."""
    shared = texts.sparkSession.sparkContext.broadcast(counts.astype(np.uint32).clip(max=0xFFFFFFFF))
    buckets = np.uint64(len(counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for p in pieces(batches):
            h, seg, row, line = line_tokens(p, size)
            order = rare_first(h, seg, shared.value[(h % buckets).astype(np.int64)])
            h, seg = h[order], seg[order]
            start = np.ones(len(h), bool)
            start[1:] = seg[1:] != seg[:-1]
            new = start.copy()
            new[1:] |= h[1:] != h[:-1]
            h, seg, start = h[new], seg[new], start[new]
            first = np.flatnonzero(start)
            own, n = seg[first], np.diff(np.append(first, len(h)))
            c1, c2 = identity(h, np.append(first, len(h)))
            place = np.arange(len(h)) - np.repeat(first, n)
            front = place < np.repeat(prefix_length(n, threshold), n)
            new = np.ones(len(own), bool)
            for k, key in enumerate((c1 ^ (c2 << 1)).tolist()):
                new[k] = key not in seen
                if len(seen) < _SEEN_CLASSES:
                    seen.add(key)
            front &= np.repeat(new, n)
            ends = np.append(0, np.cumsum(np.where(new, prefix_length(n, threshold), 0)))
            uid = p.column("uid").to_numpy()[row[own]]
            front_tokens = h[front].view(np.int64)
            for k in range(0, len(own), 20_000):
                a, b = ends[k], ends[min(k + 20_000, len(own))]
                cut = slice(k, k + 20_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(uid[cut]), pa.array(line[own][cut]), pa.array(c1[cut]), pa.array(c2[cut]), pa.array(n[cut]),
                     list_rows(pa.array(front_tokens[a:b]), ends[k:k + 20_001] - a)],
                    ["uid", "line", "c1", "c2", "n", "prefix"])

    return texts.select("uid", "text").mapInArrow(run, "uid long, line long, c1 long, c2 long, n long, prefix array<long>")


def _line_sets(docs: DataFrame, at: DataFrame, size: int) -> DataFrame:
    """(key, items) of the lines (uid, line) in ``at``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in pieces(batches):
            uid, line, parts = [], [], []
            for u, text, lines in zip(p.column("uid").to_pylist(), p.column("text").to_pylist(), p.column("lines").to_pylist(), strict=True):
                all_ = text.encode().split(b"\n")
                uid += [u] * len(lines)
                line += lines
                parts += [all_[k] for k in lines]
            ends = np.cumsum([0, *map(len, parts)])
            h, seg, _ = sorted_sets(*shingles(*words(np.frombuffer(b"".join(parts), np.uint8), ends), size))
            key = pa.StructArray.from_arrays([pa.array(uid, pa.int64()), pa.array(line, pa.int64())], ["uid", "line"])
            yield pa.RecordBatch.from_arrays([key, binary_rows(h, np.searchsorted(seg, np.arange(len(uid) + 1)))], ["key", "items"])

    lines = at.groupBy("uid").agg(F.collect_set("line").alias("lines"))  # lines of one document
    return (docs.select("uid", "text").join(lines, "uid").select("uid", "text", "lines")
            .mapInArrow(run, "key struct<uid:bigint,line:bigint>, items binary"))


def _candidates(frame: DataFrame, threshold: float, pre: str) -> DataFrame:
    """Pairs that pass the length and the positional filter; ``pre``: earlier line of the pair."""
    n, m = F.col("n"), F.col(f"{pre}n")
    need = F.ceil(F.lit(threshold / (1 + threshold)) * (n + m) - F.lit(1e-9))
    most = F.lit(1) + F.least(n - F.col("place"), m - F.col(f"{pre}place")) - F.lit(1)
    return (frame.filter((F.least(n, m) >= F.lit(threshold) * F.greatest(n, m) - F.lit(1e-9)) & (most >= need))
            .select(F.col(f"{pre}at").alias("a"), F.col("at").alias("b")).distinct())


def duplicate_lines(docs: DataFrame, threshold: float = 0.8, size: int = 5, buckets: int = 1 << 20) -> DataFrame:
    """(uid, line) of the lines to remove.  ``docs`` has (uid, text) without nulls."""
    counts = rarity(docs, size, buckets)
    lines = stage_table(line_classes(docs, counts, size, threshold), "lines")
    # (uid, line) as one number, whose minimum needs no sort as that of a struct does.
    at = F.col("uid").cast("decimal(20,0)") * F.lit(1 << 32) + F.col("line")
    first = lines.groupBy("c1", "c2").agg(F.min(at).alias("at"), F.count(F.lit(1)).alias("copies"))
    line = F.pmod("at", F.lit(1 << 32))
    first = stage_table(first.select("c1", "c2", F.struct(
        ((F.col("at") - line) / F.lit(1 << 32)).cast("long").alias("uid"), line.cast("long").alias("line")).alias("at"), "copies"), "first")

    # One row per token and class; c1 alone names the class here, and the join below tells
    # classes with an equal c1 apart again.
    tokens = lines.select("c1", "n", F.posexplode("prefix").alias("place", "token")).select(
        "token", "c1", (F.col("n") * F.lit(1 << 32) + F.col("place")).alias("size"))
    w = Window.partitionBy("token")
    tokens = (tokens.withColumns({"low": F.min("c1").over(w), "high": F.max("c1").over(w)}).filter("low < high")
              .groupBy("token", "c1").agg(F.min("size").alias("size")))
    tokens = stage_table(tokens.select("token", "c1", F.shiftright("size", 32).alias("n"), F.col("size").bitwiseAND(F.lit(0xFFFFFFFF)).alias("place")), "tokens")
    w = Window.partitionBy("token").orderBy("at")
    tokens = stage_table(
        tokens.join(first.select("c1", "at"), "c1")
        .select("token", "at", "n", "place", *[F.first(c).over(w).alias(f"head_{c}") for c in ("at", "n", "place")],
                F.row_number().over(w).alias("nth")), "tokens")

    pairs = stage_table(_candidates(tokens.filter("nth > 1"), threshold, "head_"), "pairs")
    sets = stage_table(_line_sets(docs, tokens.select("at.uid", "at.line").distinct(), size), "sets")
    gone = stage_table(verify(pairs, sets, threshold).select(F.col("b").alias("at")).distinct(), "gone")
    open_ = tokens.filter("nth > 2").drop("head_at", "head_n", "head_place").join(gone, "at", "left_anti")
    earlier = tokens.filter("nth > 1").select("token", *[F.col(c).alias(f"e_{c}") for c in ("at", "n", "place", "nth")])
    rest = _candidates(open_.join(earlier, "token").filter(F.col("e_nth") < F.col("nth")), threshold, "e_")
    gone = gone.union(verify(rest, sets, threshold).select(F.col("b").alias("at"))).distinct()

    known = first.join(gone.withColumn("gone", F.lit(True)), "at", "left").filter("copies > 1 or gone")
    return (lines.select("uid", "line", "c1", "c2").join(known, ["c1", "c2"])
            .filter(F.col("gone") | (F.struct("uid", "line") != F.col("at"))).select("uid", "line"))


def dedup_lines(docs: DataFrame, threshold: float = 0.8, size: int = 5, buckets: int = 1 << 20, id_col: str = "doc_id",
                text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, keep..., uid, text, n_lines, n_removed): each document without its removed lines."""
    if set(keep) & {"uid", "text", "n_lines", "n_removed", "lines", id_col}:
        raise ValueError("keep names a column that the result makes itself")
    prepare(docs.sparkSession)
    docs = texts_of(with_uid(docs.select(id_col, *keep, text_col), id_col), id_col, *keep, "uid", text_col=text_col)
    cut = duplicate_lines(docs, threshold, size, buckets)
    cut = cut.groupBy("uid").agg(F.collect_list("line").alias("lines"))  # lines of one document

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in pieces(batches):
            out, n, r = [], [], []
            for text, lines in zip(p.column("text").to_pylist(), p.column("lines").to_pylist(), strict=True):
                drop = set(lines or ())
                out.append(text if not drop else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in drop))
                n.append(text.count("\n") + 1)
                r.append(len(drop))
            yield pa.RecordBatch.from_arrays([*p.columns[:-2], pa.array(out, pa.string()), pa.array(n, pa.int64()), pa.array(r, pa.int64())],
                                             [*p.schema.names[:-2], "text", "n_lines", "n_removed"])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema if f.name != "text")
    return (docs.join(cut, "uid", "left").select(id_col, *keep, "uid", "text", "lines")
            .mapInArrow(run, schema + "text string, n_lines long, n_removed long"))
