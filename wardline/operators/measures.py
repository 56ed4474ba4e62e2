"""Measurement extraction: item labelling, plausibility bounds, range rules,
unit conversion and the wide sparse projection.

Everything here is one projection over the joined rows (CASE chains and
IN-lists, compiled by whole-stage codegen).  Item tables are passed as
specs (``wardline.specs``), so the same code serves labs and vitals, 48 h
and 96 h, cases and controls.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.operators.joins import window_join
from wardline.specs import LabelSpec


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def label_items(item, labels: Sequence[tuple[int, str]]) -> Column:
    """item id -> label (several ids may share a label); unmatched -> NULL."""
    item = _col(item)
    by_label: dict[str, list[int]] = {}
    for i, lab in labels:
        by_label.setdefault(lab, []).append(i)
    expr = None
    for lab, ids in by_label.items():
        cond = item.isin(ids)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return F.lit(None).cast("string") if expr is None else expr


def bound_values(item, value, bounds: Sequence[tuple[int, float | None, float | None]]) -> Column:
    """Per-item plausibility limits: a value below ``lower`` or above ``upper``
    becomes NULL; other items and in-range values pass unchanged.

    Items sharing the same limits are tested with one IN-list branch, so the
    CASE has one branch per distinct limit pair instead of one per item.
    """
    item, value = _col(item), _col(value)
    per_item: dict[int, list[tuple[float | None, float | None]]] = {}
    for i, lo, hi in bounds:
        per_item.setdefault(i, []).append((lo, hi))
    groups: dict[tuple, list[int]] = {}
    for i, lims in per_item.items():
        groups.setdefault(tuple(lims), []).append(i)
    expr = None
    for lims, ids in groups.items():
        outside = []
        for lo, hi in lims:
            if lo is not None:
                outside.append(value < F.lit(float(lo)))
            if hi is not None:
                outside.append(value > F.lit(float(hi)))
        if not outside:
            continue
        cond = item.isin(ids) & reduce(lambda a, b: a | b, outside)
        expr = F.when(cond, F.lit(None)) if expr is None else expr.when(cond, F.lit(None))
    return value if expr is None else expr.otherwise(value).cast("double")


def _range_cond(value: Column, lo, lo_incl, hi, hi_incl) -> Column | None:
    parts = []
    if lo is not None:
        parts.append(value >= F.lit(float(lo)) if lo_incl else value > F.lit(float(lo)))
    if hi is not None:
        parts.append(value <= F.lit(float(hi)) if hi_incl else value < F.lit(float(hi)))
    return reduce(lambda a, b: a & b, parts) if parts else None


def classify_items(item, value, rules) -> Column:
    """Ordered rules ``(items, lo, lo_incl, hi, hi_incl, measure_id)`` -> measure id.

    The first rule whose item set contains the item and whose range holds
    wins; no rule -> NULL (the row is kept).  The range is tested on the raw
    value (before unit conversion).
    """
    item, value = _col(item), _col(value)
    expr = None
    for items, lo, lo_incl, hi, hi_incl, mid in rules:
        cond = item.isin(list(items))
        rng = _range_cond(value, lo, lo_incl, hi, hi_incl)
        if rng is not None:
            cond = cond & rng
        expr = F.when(cond, F.lit(mid)) if expr is None else expr.when(cond, F.lit(mid))
    return F.lit(None).cast("int") if expr is None else expr


def convert_units(item, value, fahrenheit_items: Sequence[int]) -> Column:
    """Fahrenheit items -> Celsius ``(v - 32) / 1.8``; others unchanged."""
    item, value = _col(item), _col(value)
    if not fahrenheit_items:
        return value
    return F.when(item.isin(list(fahrenheit_items)), (value - F.lit(32.0)) / F.lit(1.8)).otherwise(value)


def widen(df: DataFrame, measure_col: str, value_col: str, columns, keep: Sequence[str]) -> DataFrame:
    """One CASE column per measure, no aggregation: each output row carries at
    most one non-NULL measure (``columns`` = names, or (id, name) pairs)."""
    outs = []
    for c in columns:
        mid, name = (c, c) if isinstance(c, str) else c
        outs.append(F.when(F.col(measure_col) == F.lit(mid), F.col(value_col)).cast("double").alias(name))
    return df.select(*[F.col(k) for k in keep], *outs)


def _prepare_events(events: DataFrame, spec, item_col: str, value_col: str,
                    keep_unlabelled: bool, positive_only: bool, event_filter: Column | None) -> DataFrame:
    if isinstance(spec, LabelSpec):
        items = spec.items if keep_unlabelled else [i for i, _ in spec.labels]
    else:
        if keep_unlabelled:
            items = list(spec.items)
        else:
            projected = {mid for mid, _ in spec.columns}
            routed = {i for r in spec.rules if r[5] in projected for i in r[0]}
            unrouted = {i for r in spec.rules for i in r[0]}
            items = [i for i in spec.items if i in routed or i not in unrouted]
    cond = F.col(item_col).isin(items)
    if positive_only:
        cond = cond & F.col(value_col).isNotNull() & (F.col(value_col) > F.lit(0))
    if event_filter is not None:
        cond = cond & event_filter
    return events.where(cond)


def measure_series(anchors: DataFrame, events: DataFrame, spec, *, keys, anchor_col: str,
                   time_col: str, hours: float | str, item_col: str = "itemid",
                   value_col: str = "valuenum", how: str | None = None,
                   keep: Sequence[str] = ("icustay_id", "subject_id"),
                   out_time: str = "chart_time", keep_unlabelled: bool = False,
                   event_filter: Column | None = None, positive_only: bool | None = None,
                   **join_kw) -> DataFrame:
    """Wide, sparse series of measurements in ``[anchor - hours, anchor]``.

    * ``LabelSpec`` (labs): events with ``value > 0`` and the item in the
      spec are joined LEFT (an anchor without events keeps one all-NULL row);
      out-of-bounds values become NULL.
    * ``RuleSpec`` (vitals): events passing ``event_filter`` (e.g. ``error = 0``)
      are joined INNER; the measure comes from the ordered range rules and
      Fahrenheit items are converted.
    """
    is_label = isinstance(spec, LabelSpec)
    how = how or ("left" if is_label else "inner")
    positive_only = is_label if positive_only is None else positive_only
    ev = _prepare_events(events, spec, item_col, value_col, keep_unlabelled, positive_only, event_filter)
    ev = ev.select(*{k: None for k in _event_keys(keys)}, time_col, item_col, value_col)
    joined = window_join(anchors, ev, keys, anchor_col, time_col, hours, how=how, **join_kw)
    item, value = F.col(item_col), F.col(value_col)
    if is_label:
        measure = label_items(item, spec.labels)
        cleaned = bound_values(item, value, spec.bounds)
        columns = spec.columns
    else:
        measure = classify_items(item, value, spec.rules)
        cleaned = convert_units(item, value, spec.fahrenheit)
        columns = spec.columns
    rows = joined.select(*[F.col(k) for k in keep], F.col(time_col).alias(out_time),
                         measure.alias("_measure"), cleaned.alias("_value"))
    return widen(rows, "_measure", "_value", columns, [*keep, out_time])


def lab_events_before(anchors: DataFrame, events: DataFrame, spec: LabelSpec, *, keys,
                      anchor_col: str, time_col: str, hours: float, item_col: str = "itemid",
                      value_col: str = "valuenum", keep: Sequence[str] = ("icustay_id",),
                      out_time: str = "charttime", **join_kw) -> DataFrame:
    """Long rows (key, label, time, value) of labs in the window, bounded values,
    rows whose cleaned value is NULL dropped (so anchors without labs vanish)."""
    ev = _prepare_events(events, spec, item_col, value_col, True, True, None)
    ev = ev.select(*{k: None for k in _event_keys(keys)}, time_col, item_col, value_col)
    joined = window_join(anchors, ev, keys, anchor_col, time_col, hours, how="inner", **join_kw)
    item, value = F.col(item_col), F.col(value_col)
    out = joined.select(*[F.col(k) for k in keep], label_items(item, spec.labels).alias("label"),
                        F.col(time_col).alias(out_time),
                        bound_values(item, value, spec.bounds).alias(value_col))
    return out.where(F.col(value_col).isNotNull())


def stack_anchors(arms: Sequence[tuple[DataFrame, str, dict]], horizons: Sequence[int], *,
                  anchor_col: str = "anchor_time", horizon_col: str = "horizon") -> DataFrame:
    """All arms and look-back lengths as one anchor frame.

    ``arms`` are (anchors, their anchor column, tags): a row per anchor and horizon (hours) with
    the anchor columns, the time in ``anchor_col`` and the tags as constant columns.  One
    interval join with ``hours=horizon_col`` then extracts for all of them, and what used to
    be a join per arm and length is a filter on the tags.
    """
    parts = []
    for anchors, own, tags in arms:
        a = anchors.withColumnRenamed(own, anchor_col)
        parts.append(a.withColumns({k: F.lit(v) for k, v in tags.items()}))
    rows = reduce(lambda x, y: x.unionByName(y), parts)
    return rows.withColumn(horizon_col, F.explode(F.array(*[F.lit(int(h)) for h in horizons])))


def measured_keys(anchors: DataFrame, events: DataFrame, spec, *, keys, anchor_col: str, time_col: str, hours: float | str,
                  keep: Sequence[str], item_col: str = "itemid", value_col: str = "valuenum", event_filter: Column | None = None,
                  **join_kw) -> DataFrame:
    """Distinct ``keep`` values of the anchors that have any event of the spec in their window.

    The presence test that the wide series would give, without building it: the join carries
    keys and times only.
    """
    ev = _prepare_events(events, spec, item_col, value_col, False, isinstance(spec, LabelSpec), event_filter)
    ev = ev.select(*{k: None for k in _event_keys(keys)}, time_col)
    return window_join(anchors, ev, keys, anchor_col, time_col, hours, how="inner", **join_kw).select(*keep).distinct()


def _event_keys(keys) -> list[str]:
    if isinstance(keys, str):
        return [keys]
    if isinstance(keys, dict):
        return list(keys.values())
    return [k if isinstance(k, str) else k[1] for k in keys]
