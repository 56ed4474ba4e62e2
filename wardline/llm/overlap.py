"""Exact overlap of hashed sets for candidate pairs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.hashing import mix


def numbered(h: np.ndarray, seg: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A multiset as a set: an item that occurs c times becomes c different items.

    Sets made so overlap by the minima of the counts.  Items come sorted within a segment.
    """
    first = np.cumsum(count) - count
    nth = np.arange(count.sum()) - np.repeat(first, count)
    h, seg = np.repeat(h, count), np.repeat(seg, count)
    h = np.where(nth == 0, h, mix(h + nth.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)))
    order = np.lexsort((h, seg))
    return h[order], seg[order]


def identity(h: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each set of items (two sums of scrambled items), whatever their order."""
    out = []
    for salt in (0x51ED270B, 0x2545F491):
        total = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(mix(h ^ np.uint64(salt * 0x1000193)), out=total[1:])
        out.append(mix(total[offsets[1:]] - total[offsets[:-1]] + np.diff(offsets).astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted arrays of distinct items; two empty sets have likeness 1."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    common = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return common / (len(a) + len(b) - common)


def verify(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose ``items`` (sorted 64-bit values) have a Jaccard likeness of
    ``threshold`` or more, with it as ``likeness``.  ``sets`` has (key, items)."""
    left = sets.select(F.col("key").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("key").alias("b"), F.col("items").alias("y"))
    kind = pairs.schema["a"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                b = batch.slice(start, 256)
                likeness = [jaccard(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64))
                            for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist(), strict=True)]
                likeness = pa.array(likeness, pa.float64())
                out = pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), likeness], ["a", "b", "likeness"])
                yield out.filter(pa.compute.greater_equal(likeness, threshold))

    return (pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y")
            .mapInArrow(run, f"a {kind}, b {kind}, likeness double"))
