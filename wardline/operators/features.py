"""Feature preparation: recodes and encodings, horizon exclusion, sparse-column
dropping, min-max scaling, forward fill, sequence assembly and padding,
seeded splits and folds.

Per-stay windows (forward fill, sequence assembly) are partitioned by the
stay: a stay's rows are its observed hours inside a fixed look-back
window, so these groups are bounded by construction.  Everything global
(splits, folds, encodings, scaling statistics) uses aggregates, scalar
subqueries or the distributed index of ``indexing``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.functions.scalar import recode_contains
from wardline.functions.temporal import diff_hours
from wardline.operators.indexing import global_index, hash_digits_for, hash_prefix_bucket, range_index
from wardline.operators.joins import bounded_broadcast, join_null_safe
from wardline.operators.matching import seeded_order_key
from wardline.session import materialize


def _list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def recode_vocab(patterns: Sequence[str], default: str) -> list[str]:
    """Values ``recode_contains`` can produce (capitalised), sorted."""
    return sorted({capitalise_text(p) for p in [*patterns, default]})


def capitalise_text(s: str) -> str:
    return s[:1] + s[1:].lower()


def one_hot(df: DataFrame, col: str, vocab: Sequence[str], drop: bool = True) -> DataFrame:
    """One 0/1 int column per category of a known vocabulary (sorted names)."""
    out = df.withColumns({v: (F.col(col) == F.lit(v)).cast("int") for v in sorted(vocab)})
    return out.drop(col) if drop else out


def label_encode(df: DataFrame, col: str, name: str | None = None,
                 fit_on: DataFrame | None = None) -> DataFrame:
    """Categories sorted, coded 0..k-1 (fit on ``fit_on`` or on ``df``); NULL stays NULL.

    The dictionary (distinct values, read in one pass) is numbered over range partitions, so it
    may be as large as it likes and its values may share a prefix; it is broadcast if Spark finds it small.
    """
    name = name or col
    src = (fit_on if fit_on is not None else df).select(F.col(col).alias("_value")).where(F.col(col).isNotNull()).distinct()
    codes = range_index(src, ["_value"], name="_code")
    out = df.join(codes, F.col(col) == F.col("_value"), "left").drop("_value")
    return out.withColumn(name, F.col("_code").cast("long")).drop("_code")


def exclude_horizon(df: DataFrame, anchor_col: str, time_col: str, hours: float = 3,
                    name: str = "hr_feature") -> DataFrame:
    """Hours before the anchor minus the excluded horizon; rows inside the
    horizon (value < 0) are dropped."""
    hr = diff_hours(anchor_col, time_col) - F.lit(float(hours))
    return df.withColumn(name, hr).where(F.col(name) >= 0)


def drop_sparse(df: DataFrame, cols: Sequence[str], min_frac: float) -> DataFrame:
    """Drop measure columns whose non-NULL fraction is below ``min_frac``.

    One aggregate job returns one row of fractions (one number per column).
    """
    cols = list(cols)
    fr = df.agg(*[(F.count(c) / F.count(F.lit(1))).alias(c) for c in cols]).first()
    keep_out = [c for c in cols if fr[c] is None or fr[c] < min_frac]
    return df.drop(*keep_out)


def minmax_fit(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One-row DataFrame of per-column min and max (NULLs ignored)."""
    return df.agg(*[F.min(c).cast("double").alias(f"min_{c}") for c in cols],
                  *[F.max(c).cast("double").alias(f"max_{c}") for c in cols])


def minmax_apply(df: DataFrame, stats: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(x - min) / (max - min)``; a constant column maps to ``x - min``
    (scale 1), NULL stays NULL, test values may fall outside [0, 1].

    ``stats`` is the one-row result of ``minmax_fit`` (two numbers per column).
    """
    st = stats.first()
    outs = {}
    for c in cols:
        lo, hi = st[f"min_{c}"], st[f"max_{c}"]
        if lo is None or hi is None:
            outs[c] = F.lit(None).cast("double")
            continue
        scale = (hi - lo) or 1.0
        outs[c] = ((F.col(c).cast("double") - F.lit(lo)) / F.lit(scale)).cast("double")
    return df.withColumns(outs)


def fold_minmax(df: DataFrame, cols: Sequence[str], fold: str = "fold", *, model: str = "model") -> DataFrame:
    """Per fold model the min and max of every column over the *other* folds, from one pass.

    The pass leaves one row per fold; the extreme over all folds but one is then the extreme of
    the rows before it and the rows after it in that small table.  NULL folds train no model
    and are no part of the statistics.
    """
    stats = df.where(F.col(fold).isNotNull()).groupBy(F.col(fold).alias(model)).agg(
        *[f(c).cast("double").alias(f"{n}_{c}") for c in cols for n, f in (("min", F.min), ("max", F.max))])
    order = Window.orderBy(model)  # a row per fold
    sides = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    return stats.select(model, *[
        pick(*[f(f"{n}_{c}").over(w) for w in sides]).alias(f"{n}_{c}")
        for c in cols for n, f, pick in (("min", F.min, F.least), ("max", F.max, F.greatest))])


def fold_scale(df: DataFrame, cols: Sequence[str], folds: int, fold: str = "fold", *, model: str = "model",
               held_out: str = "is_valid") -> DataFrame:
    """A copy of every row for each fold model, scaled with the model's own training rows.

    ``model`` is the fold that the model leaves out and ``held_out`` marks the rows of that fold; scaling is
    that of ``minmax_apply``.  The statistics are one row per fold, computed once and broadcast.
    """
    stats = F.broadcast(fold_minmax(df, cols, fold, model=model))
    copies = df.withColumn(model, F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
    j = copies.join(stats, model)
    out = {}
    for c in cols:
        lo, hi = F.col(f"min_{c}"), F.col(f"max_{c}")
        out[c] = (F.col(c).cast("double") - lo) / F.when(hi == lo, F.lit(1.0)).otherwise(hi - lo)
    j = j.withColumns({**out, held_out: F.when(F.col(fold) == F.col(model), 1).otherwise(0)})
    return j.drop(*[f"{n}_{c}" for c in cols for n in ("min", "max")])


def forward_fill(df: DataFrame, key, order, cols: Sequence[str], fill: float | None = 0.0) -> DataFrame:
    """Per key in ``order``: carry the last non-NULL value forward, then fill
    the rest (leading NULLs) with ``fill``.  Only existing rows are filled
    (no densified grid)."""
    w = (Window.partitionBy(*_list(key)).orderBy(*[F.col(c) for c in _list(order)])
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    outs = {}
    for c in cols:
        e = F.last(F.col(c), ignorenulls=True).over(w)
        outs[c] = F.coalesce(e, F.lit(fill)) if fill is not None else e
    return df.withColumns(outs)


def assemble_sequences(df: DataFrame, key: str, hour: str, cols: Sequence[str],
                       name: str = "seq") -> DataFrame:
    """One row per key: the hour-ordered matrix ``[[hour, c1, c2, ...], ...]``
    (hour kept as the first feature) and its length."""
    rows = F.struct(F.col(hour).cast("double").alias("h"),
                    F.array(F.col(hour).cast("double"), *[F.col(c).cast("double") for c in cols]).alias("v"))
    g = df.groupBy(key).agg(F.sort_array(F.collect_list(rows)).alias("_rows"))
    return g.select(key, F.transform("_rows", lambda r: r["v"]).alias(name),
                    F.size("_rows").alias("length"))


def pad_sequences(df: DataFrame, key: str, seq: str = "seq", length: str = "length", *,
                  batch_size: int = 32, seed: int = 42) -> DataFrame:
    """Batch the sequences (seeded order), zero-pad each to its batch's longest
    length and number them by length descending inside the batch.

    Output adds ``batch``, ``padded`` (matrix), ``pos`` (0-based position in
    the batch by length desc, then key).
    """
    keyed = df.withColumn("_h", seeded_order_key(key, seed))
    idx = global_index(keyed, ["_h", key], name="_ix", bucket=hash_prefix_bucket("_h", hash_digits_for(df.count()))).drop("_h")
    b = idx.withColumn("batch", F.floor(F.col("_ix") / F.lit(batch_size)).cast("long"))
    w = Window.partitionBy("batch")
    width = F.size(F.element_at(F.col(seq), 1))
    b = b.withColumn("_max", F.max(length).over(w))
    zero_row = F.array_repeat(F.lit(0.0), width)
    pad = F.array_repeat(zero_row, (F.col("_max") - F.col(length)).cast("int"))
    b = b.withColumn("padded", F.when(F.col(length) > 0, F.concat(F.col(seq), pad)).otherwise(F.col(seq)))
    w2 = Window.partitionBy("batch").orderBy(F.col(length).desc(), F.col(key))
    return b.withColumn("pos", (F.row_number().over(w2) - 1).cast("long")).drop("_ix", "_max")


# ---------------------------------------------------------------------------
def _label_counts(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """(label, _nl) with the rows per label, broadcast where there are few labels (checked), and all rows."""
    n = materialize(df.groupBy(label).agg(F.count(F.lit(1)).alias("_nl")))
    rows, labels = n.agg(F.coalesce(F.sum("_nl"), F.lit(0)), F.count(F.lit(1))).first()
    return bounded_broadcast(n, 1_000_000, labels)[0], rows


def stratified_split(df: DataFrame, id_col: str, label: str, frac: float, *, seed: int = 42,
                     name: str = "is_test", hash_digits: int | None = None) -> DataFrame:
    """Per label, the first ``round(n_label * frac)`` rows of the seeded order
    are test (``is_test`` = 1), the rest train: same class proportions."""
    n, rows = _label_counts(df, label)
    keyed = df.withColumn("_h", seeded_order_key(id_col, seed))
    idx = global_index(keyed, ["_h", id_col], group=[label], name="_ix",
                       bucket=hash_prefix_bucket("_h", hash_digits or hash_digits_for(rows)))
    j = join_null_safe(idx, n, [label])
    cut = F.round(F.col("_nl") * F.lit(float(frac))).cast("long")
    return j.withColumn(name, (F.col("_ix") < cut).cast("int")).drop("_h", "_ix", "_nl")


def random_split(df: DataFrame, id_col: str, frac: float, *, seed: int = 0,
                 name: str = "is_test") -> DataFrame:
    """Test when the seeded hash of the id, read as a fraction, is below ``frac``
    (no sort, no shuffle)."""
    u = F.conv(F.substring(seeded_order_key(id_col, seed), 1, 8), 16, 10).cast("double") / F.lit(float(16 ** 8))
    return df.withColumn(name, (u < F.lit(float(frac))).cast("int"))


def stratified_folds(df: DataFrame, id_col: str, label: str, k: int = 5, *, seed: int = 42,
                     name: str = "fold", hash_digits: int | None = None) -> DataFrame:
    """Fold = position in the seeded order within the label, modulo k: folds are
    disjoint, complete and balanced per label (sizes differ by at most 1)."""
    keyed = df.withColumn("_h", seeded_order_key(id_col, seed))
    idx = global_index(keyed, ["_h", id_col], group=[label], name="_ix",
                       bucket=hash_prefix_bucket("_h", hash_digits or hash_digits_for(df.count())))
    return idx.withColumn(name, (F.col("_ix") % F.lit(k)).cast("int")).drop("_h", "_ix")
