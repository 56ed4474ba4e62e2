"""Join operators: interval (window) join, null-aware NOT IN, semi/anti helpers.

Scale notes
-----------
* ``window_join`` equi-joins on the entity key *and* a coarse time bucket.
  Each anchor window is exploded into the few buckets it overlaps (a 48 h
  window over 24 h buckets is 3 rows), every event falls in exactly one
  bucket, and the exact ``BETWEEN`` test is the join condition.  A key that
  holds a large share of the event log is therefore spread over many
  (key, bucket) partitions instead of landing in one task, and AQE's skew
  join can split what is still too big.
* Anchors are broadcast only after their row count has been checked against
  ``broadcast_rows``; beyond that the join shuffles both sides on
  (key, bucket).  The event log is never broadcast.
* A LEFT interval join reads the event log once.  Its cells are as long as the
  longest window, so that a window ends in one cell and begins in the one before:
  an anchor goes to the cell in which its window ends, an event to its own cell
  and the next one, and an anchor meets all its events in that single (key, cell)
  group.  An outer join on the cell is therefore exact, and anchors without
  events come out of the same pass.  Events of cells without an anchor go
  before the shuffle, if the cells are few enough to be broadcast (checked).
* ``hours`` may be a column of the anchors: windows of several lengths, arms and
  labels are then one stacked anchor frame and one join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.temporal import epoch_micros

DEFAULT_BROADCAST_ROWS = 2_000_000
_US_PER_HOUR = 3_600_000_000


def _key_pairs(keys) -> list[tuple[str, str]]:
    if isinstance(keys, str):
        return [(keys, keys)]
    if isinstance(keys, Mapping):
        return list(keys.items())
    return [(k, k) if isinstance(k, str) else tuple(k) for k in keys]


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                      rows: int | None = None) -> tuple[DataFrame, bool]:
    """Hint a broadcast only when the row count is known to be within ``max_rows``.

    ``rows`` may be passed when the caller already knows the count; otherwise
    the DataFrame is counted (call on materialized, small intermediates).
    """
    n = df.count() if rows is None else rows
    if n <= max_rows:
        return F.broadcast(df), True
    return df, False


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join in which NULL keys match each other; the keys appear once."""
    names = {c: f"_rk_{i}" for i, c in enumerate(on)}
    r = right.withColumnsRenamed(names)
    cond = [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()]
    return left.join(r, reduce(lambda x, y: x & y, cond), how).drop(*names.values())


def _time_bounds(anchors: DataFrame, events: DataFrame, anchor_col: str, time_col: str, lo_us: Column,
                 hi_us: int) -> tuple[int, int, Column | None]:
    """Anchor count, longest look-back, and the events' time range as a filter that reaches
    the scan (a few numbers from one small aggregate; wall-clock columns only)."""
    n, longest, first, last = anchors.agg(F.count(F.lit(1)), F.max(lo_us), F.min(anchor_col), F.max(anchor_col)).first()
    ntz = {dict(anchors.dtypes)[anchor_col], dict(events.dtypes)[time_col]} == {"timestamp_ntz"}
    if not ntz or first is None or longest is None:
        return n, longest or 0, None
    low, high = first - timedelta(microseconds=longest), last + timedelta(microseconds=hi_us)
    return n, longest, F.col(time_col).between(*[F.lit(str(t)).cast("timestamp_ntz") for t in (low, high)])


def window_join(anchors: DataFrame, events: DataFrame, keys, anchor_col: str, time_col: str,
                hours: float | str, *, how: str = "left", after_hours: float = 0.0,
                bucket_hours: int = 24, broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                anchor_rows: int | None = None, suffix: str | None = None) -> DataFrame:
    """Interval join: events with ``anchor - hours <= time <= anchor + after_hours``.

    ``keys`` is a column name, a list of names, or a mapping anchor-col ->
    event-col; ``hours`` is a number or the name of an anchor column (a NULL there
    matches nothing).  Output: all anchor columns, then the event columns (event key
    columns dropped).  ``how='left'`` keeps an anchor without events as one
    row with NULL event columns; ``how='inner'`` drops it.  Event columns named like
    an anchor column get ``suffix``; without one they are an error.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    pairs = _key_pairs(keys)
    lo_us = (F.round(F.col(hours) * F.lit(_US_PER_HOUR)) if isinstance(hours, str)
             else F.lit(int(round(hours * _US_PER_HOUR)))).cast("long")
    hi_us = int(round(after_hours * _US_PER_HOUR))

    ev_keys = [e for _, e in pairs]
    clash = [c for c in events.columns if c in anchors.columns and c not in ev_keys]
    if clash and suffix is None:
        raise ValueError(f"event columns named like anchor columns: {clash}; drop them or give a suffix")
    events = events.withColumnsRenamed({c: c + suffix for c in clash})
    time_col = time_col + suffix if time_col in clash else time_col
    n_anchor, longest, in_range = _time_bounds(anchors, events, anchor_col, time_col, lo_us, hi_us)
    if in_range is not None:
        events = events.where(in_range)
    renamed = {e: f"_ek_{i}" for i, (_, e) in enumerate(pairs)}
    e = events
    for src, dst in renamed.items():
        e = e.withColumnRenamed(src, dst)
    a_us = epoch_micros(anchor_col)
    a = anchors.withColumns({"_a_us": a_us, "_from": a_us - lo_us, "_until": a_us + F.lit(hi_us)})
    e = e.withColumn("_e_us", epoch_micros(time_col))
    n_anchor = n_anchor if anchor_rows is None else anchor_rows
    pick = {"anchors": list(anchors.columns), "events": [c for c in events.columns if c not in ev_keys]}
    if how == "left":
        return _left_by_cell(a, e, [(ak, renamed[ek]) for ak, ek in pairs], max(longest + hi_us, 1), n_anchor <= broadcast_rows, pick)

    bucket_us = int(bucket_hours * _US_PER_HOUR)
    a = a.withColumn("_bkt", F.explode(F.sequence(_cell("_from", bucket_us), _cell("_until", bucket_us))))
    e = e.withColumn("_bkt", _cell("_e_us", bucket_us))
    # The exploded side is at most this many buckets per anchor.
    per_anchor = int((longest + hi_us) // bucket_us) + 2
    a_side, _ = bounded_broadcast(a, broadcast_rows, n_anchor * per_anchor)
    return _matched(a_side, e, [(ak, renamed[ek]) for ak, ek in pairs] + [("_bkt", "_bkt")], "inner", pick)


def _cell(time_us: str, width_us: int) -> Column:
    return F.floor(F.col(time_us) / F.lit(width_us))


def _matched(a: DataFrame, e: DataFrame, on: Sequence[tuple[str, str]], how: str, pick: Mapping[str, Sequence[str]]) -> DataFrame:
    """The equi join on ``on`` with the exact time test, and the wanted columns of either side."""
    cond = [a[x] == e[y] for x, y in on]
    cond.append(e["_e_us"].between(a["_from"], a["_until"]))
    joined = a.join(e, reduce(lambda x, y: x & y, cond), how)
    return joined.select(*[a[c] for c in pick["anchors"]], *[e[c] for c in pick["events"]])


def _left_by_cell(a: DataFrame, e: DataFrame, pairs: Sequence[tuple[str, str]], width_us: int, few: bool,
                  pick: Mapping[str, Sequence[str]]) -> DataFrame:
    """Left outer interval join in one pass over the events.

    No window is longer than ``width_us``, so an event inside the window of an anchor
    lies in the cell in which the window ends, or in the cell before.
    """
    a = a.withColumn("_cell", _cell("_until", width_us))
    own = _cell("_e_us", width_us)
    e = e.withColumn("_cell", F.explode(F.array(own, own + F.lit(1))))
    if few:
        names = {x: f"_c_{i}" for i, (x, _) in enumerate(pairs)}
        cells = a.groupBy(*[F.col(x).alias(n) for x, n in names.items()], F.col("_cell").alias("_c_cell")).agg(
            F.min("_from").alias("_c_from"), F.max("_until").alias("_c_until"))
        near = [e[y] == F.col(names[x]) for x, y in pairs]
        near += [e["_cell"] == F.col("_c_cell"), e["_e_us"].between(F.col("_c_from"), F.col("_c_until"))]
        # One row per cell at most, so nothing is repeated; no more rows than anchors, whose number is checked.
        e = e.join(F.broadcast(cells), reduce(lambda x, y: x & y, near)).select(*e.columns)
    return _matched(a, e, [*pairs, ("_cell", "_cell")], "left", pick)


def not_in(df: DataFrame, col: str, sub: DataFrame, sub_col: str | None = None) -> DataFrame:
    """SQL ``col NOT IN (SELECT sub_col FROM sub)`` with three-valued logic.

    * sub empty            -> every row kept (also NULL ``col``)
    * sub contains a NULL  -> no row kept
    * otherwise            -> rows with non-NULL ``col`` not present in sub

    Planned as an ordinary (shuffle or broadcast) ``left_anti`` join plus one
    scalar subquery, so a large ``sub`` never falls back to a nested loop.
    """
    sub_col = sub_col or col
    keys = sub.select(F.col(sub_col).alias("_nk"))
    stats = keys.select(F.struct(F.count(F.lit(1)).alias("n"),
                                 F.coalesce(F.max(F.col("_nk").isNull().cast("int")), F.lit(0)).alias("h"))).scalar()
    anti = df.join(keys.where(F.col("_nk").isNotNull()).distinct(),
                   df[col] == F.col("_nk"), "left_anti")
    return anti.where((stats["n"] == 0) | (F.col(col).isNotNull() & (stats["h"] == 0)))


def semi_all(df: DataFrame, key: str, others: Sequence[DataFrame], other_key: str | None = None) -> DataFrame:
    """Rows whose ``key`` is present in every frame of ``others`` (chained left semi joins)."""
    other_key = other_key or key
    out = df
    for o in others:
        out = out.join(o.select(F.col(other_key).alias(key)).distinct(), on=key, how="left_semi")
    return out


def anti(df: DataFrame, other: DataFrame, on) -> DataFrame:
    """``LEFT JOIN other ... WHERE other.key IS NULL``."""
    return df.join(other, on=on, how="left_anti")


def outer_merge(frames: Sequence[DataFrame], keys) -> DataFrame:
    """N-way FULL OUTER JOIN USING keys (keys coalesced)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return reduce(lambda l, r: l.join(r, on=keys, how="full"), frames)


def concat(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name; columns missing in a frame become NULL."""
    return reduce(lambda l, r: l.unionByName(r, allowMissingColumns=True), frames)


def exclude(df: DataFrame, preds: Sequence[Column]) -> DataFrame:
    """``WHERE NOT (p1 OR p2 OR ...)``: a row whose predicates are all FALSE or
    NULL with at least one NULL is dropped (three-valued logic)."""
    return df.where(~reduce(lambda x, y: x | y, preds))
