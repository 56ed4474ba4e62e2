"""Hard-negative mining: exact integer scores by a residue-number-system GEMM.

Components are scaled to integers.  Their residues modulo a few primes below 512 are small
enough that float32 matrix products of up to 256 components are exact integers; the residues
of longer products are added up chunk by chunk.  Chinese remaindering (Garner's mixed radix)
then gives back the signed score.  By Cauchy-Schwarz no score exceeds the largest squared
norm, which sets the number of primes: two for unit vectors scaled by 256, eight at most.

The anchors are a stated query set that meets all rows, in blocks: a cell of the join is a
block of at most ``block`` anchors and one part of the rows; it holds the anchors and streams
the rows past them in the order of their ids, keeping the best few of each anchor.  Window
functions select over the cells, after a map-side limit.  A first pass finds each anchor's
positives, whose scores set the windows of the second pass, which finds the negatives.  No
cell depends on labels, so a label that holds most rows makes no cell larger; the work is
rows x anchors, as the question asks, and each row is sent once to each block of anchors.

Defined results: rows with a null label, a null vector, or a null or non-finite component take
no part, nor do rows whose scaled squared norm is 2^62 or more, as no long holds their
scores; vectors of different lengths do not meet; an empty vector scores 0 with other empty
ones.  Repeated rows and ids are rows of their own (an anchor's copy is another row); ties go
to the smaller id, null ids last, and null ids are reported as null.  A positive of negative
score has no window, so no negatives.  An empty table, or one without anchors, gives an empty
result; extra columns are dropped, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import binary_rows, prepare, stage_table

#: Primes below 512, largest first: the residues in (-p/2, p/2) are below 256.
PRIMES = (509, 503, 499, 491, 487, 479, 467, 463)
#: 256 products of two residues below 2^8 stay under 2^24, where float32 holds every integer.
CHUNK = 256
_NONE = np.iinfo(np.int64).min


def primes_for(bound: int) -> list[int]:
    """Primes whose product is more than four times ``bound``, so that signs stay far apart."""
    out, product = [], 1
    for p in PRIMES:
        if product > 4 * max(bound, 1):
            break
        out.append(p)
        product *= p
    if product <= 4 * bound:
        raise ValueError("scores too large")
    return out


def residues(x: np.ndarray, p: int) -> np.ndarray:
    """Balanced residues of integers, as float32."""
    r = np.mod(x, p)
    return np.where(r > p // 2, r - p, r).astype(np.float32)


def product_mod(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """a @ b.T modulo p, from float32 products of at most ``CHUNK`` components."""
    out = np.zeros((len(a), len(b)), np.int32)
    for k in range(0, a.shape[1], CHUNK):
        out += (a[:, k:k + CHUNK] @ b[:, k:k + CHUNK].T).astype(np.int32) % p
    return out % p


def signed(parts: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """The integers of smallest absolute value with these residues (Garner's algorithm)."""
    digits: list[np.ndarray] = []
    for k, p in enumerate(primes):
        d, weight = parts[k].astype(np.int64), 1
        for q, e in zip(primes[:k], digits, strict=True):
            d = d - e * weight
            weight = weight * q % p
        digits.append(d * pow(weight, -1, p) % p)
    total, size, product = np.zeros(parts[0].shape, np.uint64), np.zeros(parts[0].shape), 1
    for p, d in zip(primes, digits, strict=True):
        total += d.astype(np.uint64) * np.uint64(product & 0xFFFFFFFFFFFFFFFF)
        size += d * float(product)
        product *= p
    # Modulo 2^64 this is right even where the product of the primes is larger.
    return np.where(size > product / 2, total - np.uint64(product & 0xFFFFFFFFFFFFFFFF), total).view(np.int64)


def scores(a: np.ndarray, b: np.ndarray, primes: list[int]) -> np.ndarray:
    """Exact inner products of integer rows."""
    return signed([product_mod(residues(a, p), residues(b, p), p) for p in primes], primes)


def integer_vectors(rows: DataFrame, scale: int) -> DataFrame:
    """(id, label, anchor, width, norm, q) of the rows that take part; q holds 32-bit integers."""
    v = F.col("v")
    good = rows.filter(F.col("label").isNotNull() & v.isNotNull()).filter(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column("v")
            at = np.append(0, np.cumsum(pa.compute.list_value_length(col).to_numpy())).astype(np.int64)
            with np.errstate(over="ignore"):
                q = np.floor(col.flatten().to_numpy(zero_copy_only=False) * scale)
                row = np.repeat(np.arange(len(col)), np.diff(at))
                norm = np.bincount(row, q * q, len(col))
            ok = norm < 2.0**62
            exact = np.bincount(row[ok[row]], minlength=len(col))
            q = q[ok[row]].astype(np.int64)
            off = np.append(0, np.cumsum(exact))
            norm = np.add.reduceat(np.append(q * q, 0), off[:-1]) * (exact > 0)
            out = pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in ("id", "label", "anchor")], pa.array(exact), pa.array(norm), binary_rows(q.astype(np.int32), off)],
                ["id", "label", "anchor", "width", "norm", "q"])
            yield out.filter(pa.array(ok))

    return good.mapInArrow(run, "id long, label long, anchor boolean, width long, norm long, q binary")


class _Best:
    """The first k columns of each row by score, among blocks of columns that come in order."""

    def __init__(self, rows: int, k: int):
        self.score = np.full((rows, k), _NONE, np.int64)
        self.uid, self.id, self.null = (np.zeros((rows, k), t) for t in (np.int64, np.int64, bool))

    def meet(self, score: np.ndarray, uid: np.ndarray, id_: np.ndarray, null: np.ndarray) -> None:
        """``score`` is _NONE where a column is out of the question."""
        k, n = self.score.shape[1], len(uid)
        if not n:
            return
        every = np.arange(len(score))
        score = np.concatenate([self.score, score], 1)
        old = self.uid, self.id, self.null
        new = [np.empty_like(x) for x in (self.score, *old)]
        for j in range(k):
            at = score.argmax(1)  # the first of equal scores, so the smaller id
            new[0][:, j] = score[every, at]
            score[every, at] = _NONE
            before, col = at < k, np.maximum(at - k, 0)
            for out, kept, met in zip(new[1:], old, (uid, id_, null), strict=True):
                out[:, j] = np.where(before, kept[every, np.minimum(at, k - 1)], met[col])
        self.score, self.uid, self.id, self.null = new

    def rows(self, anchor: np.ndarray, place: int) -> list[pa.Array]:
        r, j = np.nonzero(self.score > _NONE)
        return [pa.array(anchor[r]), pa.array(np.full(len(r), place, np.int32)), pa.array(self.uid[r, j]),
                pa.array(self.id[r, j], mask=self.null[r, j]), pa.array(self.score[r, j])]


_FOUND = "anchor long, place int, uid long, id long, score long"


def _cells(dealt: DataFrame, primes: list[int], keep: int, select: Callable, step: int = 512) -> DataFrame:
    """The best ``keep`` rows of each anchor and place in each cell.

    ``dealt`` comes sorted: the anchors of a cell and width first, then its rows by id.
    ``select(anchors, score, mine, other)`` gives (place, scores) with _NONE for what is out
    of the question; ``anchors`` holds the columns of the anchors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, cell = None, [], None

        def done():
            if cell is not None:
                for place, best in cell["best"].items():
                    yield pa.RecordBatch.from_arrays(best.rows(cell["uid"], place), ["anchor", "place", "uid", "id", "score"])

        for batch in batches:
            now = np.stack([batch.column(c).to_numpy() for c in ("cell", "width")], 1)
            cuts = np.flatnonzero((now[1:] != now[:-1]).any(1)) + 1
            for a, z in zip(np.append(0, cuts), np.append(cuts, len(now)), strict=True):
                if a == z:
                    continue
                here, b = tuple(now[a].tolist()), batch.slice(a, z - a)
                if here != key:
                    yield from done()
                    key, held, cell = here, [], None
                query = b.column("query").to_numpy(zero_copy_only=False)
                if query.any():
                    held.append(b.filter(pa.array(query)))
                if query.all() or not held:
                    continue
                if cell is None:
                    own = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    held, q = [own], _integers(own)
                    cell = {"uid": own.column("uid").to_numpy(), "label": own.column("label").to_numpy(), "best": {},
                            "windows": own.column("windows").to_pylist(), "q": [residues(q, p) for p in primes]}
                rest = b.filter(pa.array(~query))
                for k in range(0, rest.num_rows, step):
                    part = rest.slice(k, step)
                    q = _integers(part)
                    score = signed([product_mod(x, residues(q, p), p) for x, p in zip(cell["q"], primes, strict=True)], primes)
                    id_ = part.column("id")
                    met = part.column("uid").to_numpy(), id_.fill_null(0).to_numpy(), id_.is_null().to_numpy(zero_copy_only=False)
                    other = cell["uid"][:, None] != met[0][None, :]
                    same = cell["label"][:, None] == part.column("label").to_numpy()[None, :]
                    for place, out in select(cell, score, same, other):
                        cell["best"].setdefault(place, _Best(len(score), keep)).meet(out, *met)
        yield from done()

    return dealt.mapInArrow(run, _FOUND)


def _integers(b: pa.RecordBatch) -> np.ndarray:
    width = b.column("width")[0].as_py()
    return np.frombuffer(b"".join(b.column("q").to_pylist()), np.int32).reshape(b.num_rows, width).astype(np.int64)


def _positives(cell: dict, score: np.ndarray, same: np.ndarray, other: np.ndarray):
    yield 0, np.where(same & other, score, _NONE)


def _negatives(cell: dict, score: np.ndarray, same: np.ndarray, other: np.ndarray):
    # Window j of every anchor; anchors with fewer positives have an empty one there.
    if "bounds" not in cell:
        most = max(map(len, cell["windows"]), default=0)
        cell["bounds"] = np.array([[(x["low"], x["high"]) for x in w] + [(1, 0)] * (most - len(w)) for w in cell["windows"]],
                                  np.int64).reshape(len(cell["windows"]), most, 2)
    score = np.where(same, _NONE, score)
    for j in range(cell["bounds"].shape[1]):
        low, high = cell["bounds"][:, j, 0, None], cell["bounds"][:, j, 1, None]
        yield j + 1, np.where((score >= low) & (score <= high), score, _NONE)


def _deal(rows: DataFrame, anchors: DataFrame, blocks: int, parts: int) -> DataFrame:
    """Every anchor to each part of the rows, every row to each block of anchors."""
    block, part = F.pmod(F.xxhash64("uid", F.lit(1)), F.lit(blocks)), F.pmod(F.xxhash64("uid", F.lit(2)), F.lit(parts))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    cols = ["uid", "id", "label", "width", "q", "windows"]
    a = anchors.withColumn("part", every(parts)).select((block * parts + F.col("part")).alias("cell"), F.lit(True).alias("query"), *cols)
    windows = F.lit(None).cast(anchors.schema["windows"].dataType).alias("windows")
    r = rows.withColumn("block", every(blocks)).select((F.col("block") * parts + part).alias("cell"), F.lit(False).alias("query"), *cols[:-1], windows)
    return (a.unionByName(r).repartitionById(blocks * parts, F.col("cell").cast("int"))
            .sortWithinPartitions("cell", "width", F.col("query").desc(), F.col("id").asc_nulls_last(), "uid"))


def hard_negatives(rows: DataFrame, anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", *,
                   positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256,
                   block: int = 4096, part_rows: int = 65536) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows for which ``anchor`` holds.  The positives of an anchor are its first
    ``positives`` other rows of its label by score; the negatives of a positive are the first ``negatives``
    rows of other labels with low * positive_score <= 100 * score <= high * positive_score.
    """
    spark = rows.sparkSession
    prepare(spark, rows=4096)
    named = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                        F.coalesce(anchor, F.lit(False)).alias("anchor"), F.col(vec_col).cast("array<double>").alias("v"))
    rows = stage_table(integer_vectors(named, scale).withColumn("uid", F.monotonically_increasing_id()), "integers")
    n, n_anchors, bound = rows.agg(F.count(F.lit(1)), F.count_if("anchor"), F.coalesce(F.max("norm"), F.lit(0))).first()
    primes = primes_for(bound)
    blocks = max(1, -(-n_anchors // block))
    # Parts of ``part_rows`` rows; smaller ones while there are few, so that small tables spread too.
    parts = max(1, -(-n // part_rows), min(-(-n // 4096), 32))
    kind = "array<struct<low:bigint,high:bigint>>"
    anchors = rows.filter("anchor").withColumn("windows", F.array().cast(kind))
    found = _cells(_deal(rows, anchors, blocks, parts), primes, positives, _positives)
    best = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("uid")]
    place = F.row_number().over(Window.partitionBy("anchor").orderBy(*best))
    found = stage_table(found.withColumn("place", place).filter(F.col("place") <= positives), "positives")

    s = F.col("score")
    # 100 * low_score >= low * s in whole numbers: ceil and floor of a quotient of longs.
    bounds = F.struct(F.ceil(F.lit(low).cast("decimal(3,0)") * s / 100).cast("long").alias("low"),
                      F.floor(F.lit(high).cast("decimal(3,0)") * s / 100).cast("long").alias("high"))
    windows = (found.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", bounds.alias("w")))).alias("w"))  # ``positives`` at most
               .select(F.col("anchor").alias("uid"), F.transform("w", lambda x: x["w"]).cast(kind).alias("windows")))
    anchors = rows.filter("anchor").join(windows, "uid")
    hard = _cells(_deal(rows, anchors, blocks, parts), primes, negatives, _negatives)
    rank = F.row_number().over(Window.partitionBy("anchor", "place").orderBy(*best))
    hard = hard.withColumn("rank", rank).filter(F.col("rank") <= negatives).select(
        "anchor", "place", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    ids = rows.filter("anchor").select(F.col("uid").alias("anchor"), F.col("id").alias("anchor_id"))
    named = found.select("anchor", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")).join(ids, "anchor")
    return named.join(hard, ["anchor", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
