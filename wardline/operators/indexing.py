"""Distributed global order helpers: dense index (M1), running sum (M3) and
average ranks (M2).

``row_number()`` or a running ``sum`` over a window without PARTITION BY
moves every row into one task.  Here the order key is first cut into
order-preserving buckets (quantile splits of a numeric key, or a fixed-width
prefix of a hash string); per-bucket counts/sums form a table bounded by the
bucket count, whose running offsets are computed on that small table and
broadcast back.  The final window is partitioned by bucket, and the number of buckets grows with
the rows, so no task sees more than about ``ROWS_A_BUCKET`` rows per bucket.  The result does not depend on
where the bucket boundaries fall, only on the total order, so approximate
split points are exact here.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.operators.joins import bounded_broadcast, join_null_safe
from wardline.session import materialize

#: Rows that one bucket is to hold; the number of buckets follows from the number of rows.
ROWS_A_BUCKET = 200_000
#: Bounds of the number of quantile buckets (the upper one bounds the offsets table and the sketch).
FEWEST_BUCKETS, MOST_BUCKETS = 16, 20_000
_MAX_OFFSET_ROWS = 1_000_000


def _list(x) -> list:
    return [x] if isinstance(x, (str, Column)) else list(x)


def _order_cols(order, ascending: bool) -> list[Column]:
    cols = [F.col(c) if isinstance(c, str) else c for c in _list(order)]
    return [c.asc_nulls_first() if ascending else c.desc_nulls_last() for c in cols]


def hash_prefix_bucket(hex_col, digits: int = 3) -> Column:
    """Order-preserving bucket of a fixed-width lowercase hex string (md5)."""
    c = F.col(hex_col) if isinstance(hex_col, str) else hex_col
    return F.conv(F.substring(c, 1, digits), 16, 10).cast("int")


def buckets_for(rows: int, rows_a_bucket: int = ROWS_A_BUCKET) -> int:
    """Quantile buckets for so many rows."""
    return max(FEWEST_BUCKETS, min(MOST_BUCKETS, -(-rows // rows_a_bucket)))


def hash_digits_for(rows: int, rows_a_bucket: int = ROWS_A_BUCKET) -> int:
    """Leading hex digits of a hash that cut so many rows into buckets of about ``rows_a_bucket`` (5 at most)."""
    return next((d for d in range(1, 5) if 16**d * rows_a_bucket >= rows), 5)


def quantile_bucket(df: DataFrame, col: str, buckets: int, rel_err: float | None = None,
                    ascending: bool = True) -> tuple[DataFrame, str]:
    """Add ``_b``: bucket of numeric ``col`` from approximate quantile splits.

    Only ``buckets - 1`` split points reach the driver (bounded); ``rel_err`` is a quarter of a bucket unless
    given.  NULLs get bucket -1 (first when ascending), NaN the last bucket.
    """
    rel_err = 0.25 / buckets if rel_err is None else rel_err
    probs = [i / buckets for i in range(1, buckets)]
    dcol = "_bq_x"
    d = df.withColumn(dcol, F.col(col).cast("double"))
    splits = sorted({s for s in d.approxQuantile(dcol, probs, rel_err) if math.isfinite(s)})
    splits = [float("-inf"), *splits, float("inf")]
    if len(splits) < 3:
        splits = [float("-inf"), 0.0, float("inf")]
    bz = Bucketizer(splits=splits, inputCol=dcol, outputCol="_bq_b", handleInvalid="keep")
    out = bz.transform(d.withColumn(dcol, F.coalesce(F.col(dcol), F.lit(0.0))))
    b = F.when(F.col(col).isNull(), F.lit(-1)).otherwise(F.col("_bq_b").cast("int"))
    if not ascending:
        b = -b
    return out.withColumn("_b", b).drop(dcol, "_bq_b"), "_b"


def _with_bucket(df, order, bucket, buckets, ascending):
    if bucket is not None:
        b = bucket if ascending else -bucket
        return df.withColumn("_b", b)
    lead = _list(order)[0]
    if not isinstance(lead, str):
        raise ValueError("pass bucket= when the leading order key is an expression")
    out, _ = quantile_bucket(df, lead, buckets_for(df.count()) if buckets is None else buckets, ascending=ascending)
    return out


def _offsets(small: DataFrame, group: list[str], value: str) -> DataFrame:
    w = Window.partitionBy(*group).orderBy("_b") if group else Window.orderBy("_b")
    return small.withColumn("_off", F.sum(value).over(w) - F.col(value))


def _broadcast_offsets(offsets: DataFrame, group: list[str]) -> DataFrame:
    """Without groups the offsets table has at most one row per bucket (a bound
    known by construction: 16^5 hash buckets or ``MOST_BUCKETS`` + 1 quantile
    buckets), so it is broadcast directly; with groups its size is checked."""
    if not group:
        return F.broadcast(offsets)
    out, _ = bounded_broadcast(offsets, _MAX_OFFSET_ROWS)
    return out


def global_index(df: DataFrame, order, *, group: Sequence[str] = (), name: str = "idx",
                 bucket: Column | None = None, buckets: int | None = None,
                 ascending: bool = True) -> DataFrame:
    """0-based dense position of each row in ``order`` (within ``group``).

    ``order`` must be a total order (add a unique tie-breaker).  Without ``bucket`` the leading key is cut at
    quantiles into ``buckets``, whose number follows from that of the rows unless given.
    """
    group = list(group)
    b = _with_bucket(df, order, bucket, buckets, ascending)
    counts = b.groupBy(*group, "_b").agg(F.count(F.lit(1)).alias("_n"))
    offsets = _offsets(counts, group, "_n").select(*group, "_b", "_off")
    offsets = _broadcast_offsets(offsets, group)
    w = Window.partitionBy(*group, "_b").orderBy(*_order_cols(order, ascending))
    out = join_null_safe(b, offsets, [*group, "_b"]).withColumn(
        name, (F.col("_off") + F.row_number().over(w) - F.lit(1)).cast("long"))
    return out.drop("_b", "_off")


def range_index(df: DataFrame, order, *, name: str = "idx", rows: int | None = None, rows_a_part: int = 1_000_000) -> DataFrame:
    """0-based dense position of each row in ``order``, for keys of any type.

    The rows are range-partitioned by ``order`` and stored with their partition, which reads ``df`` once;
    a partition's offset is the number of rows in the partitions before it (one row per partition),
    and positions within a partition come from a window over it.  There are as many partitions as rows of
    ``rows_a_part``, and their bounds follow the data, so a common prefix of many keys does no harm.
    ``order`` must be a total order; a caller that has stored and counted ``df`` passes its ``rows``.
    """
    if rows is None:
        df = materialize(df)
        rows = df.count()
    parts = max(1, -(-rows // rows_a_part))
    keys = _order_cols(order, True)
    if parts == 1:  # ``rows_a_part`` rows at most: one task does
        return df.withColumn(name, (F.row_number().over(Window.orderBy(*keys)) - 1).cast("long"))
    placed = materialize(df.repartitionByRange(parts, *keys).withColumn("_part", F.spark_partition_id()))
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_off"))
    w = Window.partitionBy("_part").orderBy(*keys)
    out = placed.join(F.broadcast(offsets), "_part")  # a row per partition
    return out.withColumn(name, (F.col("_off") + F.row_number().over(w) - 1).cast("long")).drop("_part", "_off")


def global_cumsum(df: DataFrame, order, cols: Sequence[str], *, group: Sequence[str] = (),
                  prefix: str = "cum_", bucket: Column | None = None,
                  buckets: int | None = None, ascending: bool = True) -> DataFrame:
    """Inclusive running sums of ``cols`` in ``order`` (within ``group``)."""
    group, cols = list(group), list(cols)
    b = _with_bucket(df, order, bucket, buckets, ascending)
    sums = b.groupBy(*group, "_b").agg(*[F.sum(c).alias(f"_s_{c}") for c in cols])
    w0 = Window.partitionBy(*group).orderBy("_b") if group else Window.orderBy("_b")
    offsets = sums.select(*group, "_b", *[(F.sum(f"_s_{c}").over(w0) - F.col(f"_s_{c}")).alias(f"_o_{c}")
                                           for c in cols])
    offsets = _broadcast_offsets(offsets, group)
    w = (Window.partitionBy(*group, "_b").orderBy(*_order_cols(order, ascending))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = join_null_safe(b, offsets, [*group, "_b"])
    out = out.withColumns({f"{prefix}{c}": F.col(f"_o_{c}") + F.sum(c).over(w) for c in cols})
    return out.drop("_b", *[f"_o_{c}" for c in cols])


def avg_rank(df: DataFrame, col: str, *, name: str = "rank", group: Sequence[str] = ()) -> DataFrame:
    """1-based average rank of ``col`` (ties share the mean rank), per group.

    Ranks come from per-value counts (so heavy ties collapse to one row) and
    a distributed running sum over the distinct values.
    """
    group = list(group)
    counts = df.groupBy(*group, col).agg(F.count(F.lit(1)).alias("_tie"))
    cum = global_cumsum(counts, [col], ["_tie"], group=group)
    ranks = cum.select(*group, col, (F.col("cum__tie") - (F.col("_tie") - F.lit(1)) / F.lit(2.0))
                       .cast("double").alias(name))
    return join_null_safe(df, ranks, [*group, col])
