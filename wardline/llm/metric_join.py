"""Embedding near-dedup: an exact metric range join around pivots.

Vectors are scaled to unit length, so that cosine >= t means a distance of at most
r = sqrt(2 - 2t).  A bounded sample of vectors serves as pivots; the cell of a vector is
that of its nearest pivot.  The members of a cell are cut into blocks of at most about ``block`` rows
by hash, and a block is one row of a stored table: its vectors as bytes, and for every pivot the least and the
largest distance of a member.  By the triangle inequality two blocks hold no pair within r if for some pivot
these ranges are more than r apart.  Blocks that may hold one meet in a Cartesian product, whose tasks read
them from the stored table: nothing is copied to other cells or dealt, so the disk holds a few copies of the
vectors however many blocks there are.  Of two blocks of different cells only the members near the other cell are
compared, those within r of the farthest member of the other block along the line through both pivots; first in
single precision with a margin, then exactly in double precision.

Equal vectors are joined first and compared once.  They, and the stored blocks, keep the precision of the input;
units are computed from it wherever they are needed, by the same steps.  A task returns the links of each
vector that has any and a spanning forest of its blocks, never all pairs.  ``pivots`` grows with the
rows: one per ``block`` rows, 256 at most (a bound on what is broadcast; a cell that is
larger has more blocks).  In many dimensions r exceeds the spread of the distances and most blocks
meet; the join is then a block join of all rows, still exact, and its CPU time quadratic.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link
with nothing, nor do vectors of different lengths with each other; a cosine of exactly the threshold
links; repeated rows (one id twice) are vectors of their own, each with its links, and so are rows
without an id; ``component_id`` is the smallest id that links reach (ties are rows of one id), null where
none of them has an id; ``kept`` compares the row's id with it, nulls being equal, so all rows that bear the
smallest id are kept; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import prepare, stage_table, with_uid
from wardline.llm.components import components

_MARGIN = 1e-4           # of distances and of products in single precision
_BLOCK_NUMBERS = 1 << 22  # components in a block: of longer vectors fewer fit
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _margin(width: int) -> float:
    """Above the rounding of a product of so many single-precision components."""
    return max(_MARGIN, 2.0**-23 * (width + 2))


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of unit length, in double precision."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(1, initial=0)[:, None]  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(1))[:, None]


def _matrix(column: pa.Array, width: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


def _precision(rows: DataFrame) -> str:
    """Of the components of ``v``: single if the table's is, else double."""
    return "float32" if rows.schema["v"].dataType.simpleString() == "array<float>" else "float64"


def usable_vectors(rows: DataFrame, raw: bool = True) -> DataFrame:
    """(id, uid, width, key[, raw]) of the usable vectors ``v``: the SHA-256 of the unit vector, which tells
    equal ones, and the components as bytes."""
    kind, precision = rows.schema["id"].dataType.simpleString(), _precision(rows)
    names = ["id", "uid", "width", "key", *["raw"] * raw]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column("v")
            widths = pa.compute.fill_null(pa.compute.list_value_length(col), 0).to_numpy().astype(np.int64)
            start = np.append(0, np.cumsum(widths))[:-1]
            flat = col.flatten().to_numpy(zero_copy_only=False).astype(precision)  # null components are NaN
            for width in np.unique(widths[widths > 0]).tolist():
                at = np.flatnonzero(widths == width)
                x = flat[start[at][:, None] + np.arange(width)]
                top = np.abs(x).max(1)
                good = np.isfinite(top) & (top > 0)
                at, x = pa.array(at[good], pa.int64()), x[good]
                key = pa.array([hashlib.sha256(u).digest() for u in _unit(x)], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column("id").take(at), b.column("uid").take(at), pa.array(np.full(len(x), width)), key,
                                                  *[pa.array([v.tobytes() for v in x], pa.binary())] * raw], names)

    of = "float" if precision == "float32" else "double"
    return rows.select("id", "uid", F.col("v").cast(f"array<{of}>").alias("v")).mapInArrow(
        run, f"id {kind}, uid long, width long, key binary" + ", raw binary" * raw)


def _pivot_distance(unit: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (unit @ pivots.T), 0))


def _assign(vectors: DataFrame, pivots: dict[int, np.ndarray], precision: str) -> DataFrame:
    """Every row of ``vectors`` (width and raw among its columns) with its ``cell``, the number of its nearest pivot."""
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width in np.unique(batch.column("width").to_numpy()).tolist():
                b = batch.filter(pa.compute.equal(batch.column("width"), width))
                own = _pivot_distance(_unit(_matrix(b.column("raw"), width, precision)), shared.value[width]).argmin(1)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own.astype(np.int64))], [*b.schema.names, "cell"])

    return vectors.mapInArrow(run, f"{schema}, cell long")


_BLOCK = "block long, width long, cell long, uid binary, copies binary, raw binary, low array<double>, high array<double>"


def _pack(dealt: DataFrame, pivots: dict[int, np.ndarray], precision: str) -> DataFrame:
    """One row for every block.  Rows come sorted by block."""
    shared = dealt.sparkSession.sparkContext.broadcast(pivots)
    names = [x.split()[0] for x in _BLOCK.split(", ")]

    def packed(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        b = pa.Table.from_batches(parts).combine_chunks()
        width = b.column("width")[0].as_py()
        raw = _matrix(b.column("raw"), width, precision)
        low, high = np.full(len(shared.value[width]), np.inf), np.zeros(len(shared.value[width]))
        for k in range(0, len(raw), 512):
            gap = _pivot_distance(_unit(raw[k:k + 512]), shared.value[width])
            low, high = np.minimum(low, gap.min(0)), np.maximum(high, gap.max(0))
        of = [b.column("block")[0].as_py(), width, b.column("cell")[0].as_py(), b.column("uid").to_numpy().tobytes(),
              b.column("copies").to_numpy().tobytes(), raw.tobytes(), low.tolist(), high.tolist()]
        kinds = [pa.int64()] * 3 + [pa.binary()] * 3 + [pa.list_(pa.float64())] * 2
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(of, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            block = batch.column("block").to_numpy()
            cuts = np.flatnonzero(block[1:] != block[:-1]) + 1
            for a, z in zip(np.append(0, cuts), np.append(cuts, len(block)), strict=True):
                if held and held[0].column("block")[0].as_py() != block[a]:
                    yield packed(held)
                    held = []
                if z > a:
                    held.append(batch.slice(a, z - a))
        if held:
            yield packed(held)

    return dealt.mapInArrow(run, _BLOCK)


def _pairs(blocks: DataFrame, radius: float) -> DataFrame:
    """Columns a_ and b_ of the blocks that meet, each two of them once and each one with itself.

    Which of two is ``a`` changes from pair to pair, so that all parts of the product have work."""
    a, b = (blocks.select(*[F.col(c).alias(f"{side}_{c}") for c in blocks.columns]) for side in "ab")
    once = (F.col("a_block") == F.col("b_block")) | (
        (F.col("a_block") != F.col("b_block")) & (((F.col("a_block") + F.col("b_block")) % 2 == 1) == (F.col("a_block") < F.col("b_block"))))
    reach = F.lit(radius + _MARGIN)
    close = [F.forall(F.zip_with(f"{x}_low", f"{y}_high", lambda low, high: low <= high + reach), lambda near: near) for x, y in ("ab", "ba")]
    return a.join(b.hint("shuffle_replicate_nl"), once & (F.col("a_width") == F.col("b_width")) & close[0] & close[1]).drop(
        *[f"{side}_{c}" for side in "ab" for c in ("low", "high")], "b_width")


class _Block:
    """The members of a block and their places among all that the task has seen."""

    def __init__(self, pairs: pa.RecordBatch, row: int, side: str, precision: str):
        def of(name):
            return pairs.column(f"{side}_{name}")[row]

        self.number, self.cell, width = of("block").as_py(), of("cell").as_py(), pairs.column("a_width")[row].as_py()
        self.uid, self.copies = (np.frombuffer(of(c).as_buffer(), np.int64) for c in ("uid", "copies"))
        self.unit = _unit(np.frombuffer(of("raw").as_buffer(), precision).reshape(len(self.uid), width))
        self.single = self.unit.astype(np.float32)


class _Links:
    """The links that a task finds: their number for every member seen and a forest that joins linked ones."""

    def __init__(self, pivots: dict[int, np.ndarray], threshold: float, radius: float):
        self.pivots, self.threshold, self.radius = pivots, threshold, radius
        self.start: dict[int, int] = {}
        self.uid, self.links, self.up = (np.zeros(0, np.int64) for _ in range(3))

    def place(self, b: _Block) -> int:
        if b.number not in self.start:
            self.start[b.number] = len(self.uid)
            self.up = np.append(self.up, np.arange(len(self.uid), len(self.uid) + len(b.uid)))
            self.uid, self.links = np.append(self.uid, b.uid), np.append(self.links, np.zeros(len(b.uid), np.int64))
        return self.start[b.number]

    def meet(self, a: _Block, b: _Block) -> None:
        at, bt, same, width = self.place(a), self.place(b), a.number == b.number, a.unit.shape[1]
        i, j = np.arange(len(a.uid)), np.arange(len(b.uid))
        if a.cell != b.cell:
            # Of two vectors within r of each other the places along any line differ by r at most.
            line = self.pivots[width][a.cell] - self.pivots[width][b.cell]
            reach, x, y = self.radius * np.sqrt((line * line).sum()) + _MARGIN, a.unit @ line, b.unit @ line
            i, j = np.flatnonzero(x <= y.max() + reach), np.flatnonzero(y >= x.min() - reach)
        one, other = (b.single, a.single) if same else (b.single[j], a.single[i])
        least = np.float32(self.threshold - _margin(width))
        for k in range(0, len(j), 512):
            near = one[k:k + 512] @ other.T >= least
            if same:
                near &= np.arange(k, k + len(near))[:, None] > np.arange(len(i))
            hit = np.flatnonzero(near)
            for c in range(0, len(hit), 100_000):
                y, x = np.divmod(hit[c:c + 100_000], len(i))
                x, y = i[x], j[y + k]
                ok = np.einsum("ij,ij->i", b.unit[y], a.unit[x]) >= self.threshold
                x, y = x[ok], y[ok]
                np.add.at(self.links, x + at, b.copies[y])
                np.add.at(self.links, y + bt, a.copies[x])
                self.unite(x + at, y + bt)

    def roots(self, x: np.ndarray) -> np.ndarray:
        root = self.up[x]
        while ((above := self.up[root]) != root).any():
            root = above
        self.up[x] = root
        return root

    def unite(self, x: np.ndarray, y: np.ndarray) -> None:
        while True:
            x, y = self.roots(x), self.roots(y)
            apart = x != y
            if not apart.any():
                return
            x, y = x[apart], y[apart]
            np.minimum.at(self.up, np.maximum(x, y), np.minimum(x, y))

    def result(self) -> pa.RecordBatch:
        hit = np.flatnonzero(self.links)
        return pa.RecordBatch.from_arrays([pa.array(self.uid[hit]), pa.array(self.links[hit]), pa.array(self.uid[self.roots(hit)])], ["uid", "links", "other"])


def _join_blocks(blocks: DataFrame, pivots: dict[int, np.ndarray], precision: str, threshold: float, radius: float) -> DataFrame:
    """Partial results per vector: (uid, links, other), one row in every task that finds links of it."""
    shared = blocks.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, a = _Links(shared.value, threshold, radius), None
        for pairs in batches:
            for row, number in enumerate(pairs.column("a_block").to_pylist()):
                if a is None or a.number != number:
                    a = _Block(pairs, row, "a", precision)
                found.meet(a, a if pairs.column("b_block")[row].as_py() == number else _Block(pairs, row, "b", precision))
        yield found.result()

    return _pairs(blocks, radius).mapInArrow(run, "uid long, links long, other long")


def _stage_blocks(df: DataFrame, name: str) -> DataFrame:
    """``stage_table`` with a block, or a pair of them, to an Arrow batch."""
    conf = df.sparkSession.conf
    before = conf.get(_ARROW_ROWS)
    conf.set(_ARROW_ROWS, "1")
    try:
        return stage_table(df, name)
    finally:
        conf.set(_ARROW_ROWS, before)


def near_vectors(rows: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vec_col: str = "embedding", *,
                 block: int = 4096, most_pivots: int = 256, seed: int = 9) -> DataFrame:
    """(id, uid, n_links, component_id, kept) of every row; ``uid`` tells rows of one id apart."""
    spark = rows.sparkSession
    prepare(spark)
    rows = with_uid(rows.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v")), "id")
    precision = _precision(rows)
    # Equal vectors: one of them stands for all.
    classes = stage_table(usable_vectors(rows).groupBy("width", "key").agg(
        F.min("uid").alias("class"), F.min("id").alias("low_id"), F.count(F.lit(1)).alias("copies"), F.first("raw").alias("raw")), "class")
    total = {r.width: r.n for r in classes.groupBy("width").agg(F.count(F.lit(1)).alias("n")).limit(1001).collect()}
    if len(total) > 1000:
        raise ValueError("more than 1000 different vector lengths")
    wanted = {w: int(min(most_pivots, -(-n // block))) for w, n in total.items()}
    order = F.xxhash64(F.lit(seed), "class")
    pivots = {}
    for w, k in wanted.items():
        share = min(1.0, (2 * k + 20) / total[w])
        low = classes.filter(F.col("width") == w).filter(order.cast("double") / F.lit(2.0**64) + F.lit(0.5) <= F.lit(share))
        got = low.orderBy(order).limit(k).select("raw").collect()  # most_pivots rows at most
        if not got:
            got = classes.filter(F.col("width") == w).limit(k).select("raw").collect()
        pivots[w] = _unit(np.stack([np.frombuffer(r.raw, precision) for r in got]))
    radius = float(np.sqrt(2 - 2 * threshold))
    sizes = stage_table(_assign(classes.select("width", "raw"), pivots, precision).groupBy("width", "cell").agg(F.count(F.lit(1)).alias("n")), "cells")
    parts = []  # a row per pivot
    first = 0
    for r in sizes.orderBy("width", "cell").collect():
        parts.append((r.width, r.cell, first, -(-r.n // max(1, min(block, _BLOCK_NUMBERS // r.width)))))
        first += parts[-1][3]
    small = spark.createDataFrame(parts, "width long, cell long, first long, parts long")
    dealt = (_assign(classes.select(F.col("class").alias("uid"), "copies", "width", "raw"), pivots, precision)
             .join(F.broadcast(small), ["width", "cell"])
             .withColumn("block", F.col("first") + F.pmod(F.xxhash64("uid", F.lit(seed)), F.col("parts"))).drop("first", "parts"))
    dealt = dealt.repartition(max(1, first), "block").sortWithinPartitions("block", "uid")
    blocks = stage_table(_pack(dealt, pivots, precision), "blocks")
    found = _stage_blocks(_join_blocks(blocks, pivots, precision, threshold, radius), "found")
    counts = found.groupBy("uid").agg(F.sum("links").alias("links"))
    group = components(found.select(F.col("uid").alias("a"), F.col("other").alias("b")))

    known = (classes.join(counts.withColumnRenamed("uid", "class"), "class", "left")
             .join(group.withColumnRenamed("node", "class"), "class", "left")
             .select("width", "key", "low_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
                     F.col("component")))
    # The smallest id of a component, from its classes; a class of its own needs no look-up.
    low = known.filter("component is not null").groupBy("component").agg(F.min("low_id").alias("least"))
    known = known.join(low, "component", "left").select("width", "key", "links", F.when(
        F.col("component").isNull(), F.col("low_id")).otherwise(F.col("least")).alias("component_id"), F.lit(True).alias("usable"))
    placed = usable_vectors(rows, raw=False).join(known, ["width", "key"]).select("uid", "links", "component_id", "usable")
    out = rows.select("id", "uid").join(placed, "uid", "left").select(
        F.col("id").alias(id_col), "uid", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
