"""Aggregations: group statistics, one-scan lab panels, multi-stat features,
hourly means, exact quantiles, median imputation, cohort summary ("Table 1")
and group-difference statistics (chi-square, Kruskal-Wallis).

Scale notes
-----------
* All per-key statistics are hash aggregates with map-side partial
  aggregation; a hot key costs one partial buffer per task, not a gather.
* ``exact_quantiles`` never gathers a group's values: it counts rows per
  distinct value, takes distributed running sums of those counts
  (``global_cumsum``) and picks the order statistics by position.  Used for
  global medians (imputation) and per-arm quartiles (Table 1), where one
  group can hold a large share of all rows.
* ``agg_features`` uses ``median`` per stay: its groups are measurement
  windows of a bounded number of hours.  ``approx=True`` switches to
  ``percentile_approx`` (bounded sketch) for unbounded keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.operators.indexing import global_cumsum
from wardline.operators.joins import bounded_broadcast, join_null_safe


def _list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def group_stats(df: DataFrame, key, value: str, prefix: str) -> DataFrame:
    """avg / max / min / sample stddev per key; stddev of a single row -> 0."""
    v = F.col(value)
    return df.where(v.isNotNull()).groupBy(*_list(key)).agg(
        F.avg(v).alias(f"{prefix}_avg"), F.max(v).alias(f"{prefix}_max"),
        F.min(v).alias(f"{prefix}_min"),
        F.coalesce(F.stddev_samp(v), F.lit(0.0)).alias(f"{prefix}_stddev"))


def panel_stats(events: DataFrame, dictionary: DataFrame, panels, *, key: str = "subject_id",
                item_col: str = "itemid", label_col: str = "label",
                value_cols: dict[str, str] | None = None, num_col: str = "valuenum") -> DataFrame:
    """avg / max / min / stddev of ``num_col`` per key for several lab panels in ONE scan.

    ``panels``: (name, 'like' | 'in', pattern(s), filter column).  'like' is a
    case-insensitive substring test of the dictionary label, 'in' an exact
    label match.  A panel's rows are those whose filter column is not NULL.
    Equivalent to one aggregate per panel combined by FULL OUTER JOIN on the
    key: a key absent from a panel gets NULLs there, a key present with a
    single value gets stddev 0.
    """
    label = F.col(label_col)
    member = []
    for name, kind, pat, _ in panels:
        pats = [pat] if isinstance(pat, str) else list(pat)
        if kind == "like":
            cond = F.lower(label).contains(pats[0].lower())
        else:
            cond = label.isin(pats)
        member.append(F.when(cond, F.lit(name)))
    # item -> panels it belongs to (one row per pair); bounded by the dictionary.
    item_panels = (dictionary.select(F.col(item_col), F.explode(F.array(*member)).alias("_panel"))
                   .where(F.col("_panel").isNotNull()).distinct())
    # The map is bounded by the dictionary, not by the event log; size checked.
    item_panels, _ = bounded_broadcast(item_panels, 5_000_000)
    ev = events.join(item_panels, item_col)
    present = None
    aggs = []
    for name, _, _, fcol in panels:
        in_panel = (F.col("_panel") == F.lit(name)) & F.col(fcol).isNotNull()
        v = F.when(in_panel, F.col(num_col))
        n = F.sum(in_panel.cast("int"))
        aggs += [F.avg(v).alias(f"{name}_avg"), F.max(v).alias(f"{name}_max"),
                 F.min(v).alias(f"{name}_min"),
                 F.when(n > 0, F.coalesce(F.stddev_samp(v), F.lit(0.0))).alias(f"{name}_stddev")]
        c = in_panel
        present = c if present is None else present | c
    return ev.where(present).groupBy(key).agg(*aggs)


_STATS = {
    "mean": lambda c: F.avg(c),
    "median": lambda c: F.median(c),
    "std": lambda c: F.stddev_samp(c),
    "min": lambda c: F.min(c),
    "max": lambda c: F.max(c),
}


def agg_features(df: DataFrame, key, cols: Sequence[str],
                 stats: Sequence[str] = ("mean", "median", "std"), approx: bool = False) -> DataFrame:
    """Per-key statistics of every column, named ``<col>_<stat>`` (NULLs skipped)."""
    aggs = []
    for c in cols:
        for s in stats:
            if s == "median" and approx:
                e = F.percentile_approx(F.col(c), 0.5, 10000).cast("double")
            else:
                e = _STATS[s](F.col(c))
            aggs.append(e.cast("double").alias(f"{c}_{s}"))
    return df.groupBy(*_list(key)).agg(*aggs)


def hourly_mean(df: DataFrame, key, hour: str, cols: Sequence[str]) -> DataFrame:
    """Mean of every column per (key, hour); NULL where the hour has no value."""
    return df.groupBy(*_list(key), hour).agg(*[F.avg(c).alias(c) for c in cols])


def hourly_mean_all(frames: dict[str, tuple[DataFrame, Sequence[str]]], key, hour: str) -> DataFrame:
    """Hourly means of several series merged on (key, hour), in one aggregate.

    ``frames``: source name -> (series, its columns), no column in two of them.  The same rows as a FULL OUTER
    join of one ``hourly_mean`` per series: an hour of any series has a row, with NULLs for what the others
    lack.  ``has_<name>`` is 1 where the source has a row in that hour, 0 otherwise.
    """
    keys = [*_list(key), hour]
    parts = [df.select(*keys, *cols).withColumn(f"has_{name}", F.lit(1)) for name, (df, cols) in frames.items()]
    rows = reduce(lambda l, r: l.unionByName(r, allowMissingColumns=True), parts)
    cols = [c for _, cs in frames.values() for c in cs]
    return rows.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in cols],
                                   *[F.coalesce(F.max(f"has_{n}"), F.lit(0)).alias(f"has_{n}") for n in frames])


def value_counts(df: DataFrame, cols) -> DataFrame:
    return df.groupBy(*_list(cols)).agg(F.count(F.lit(1)).alias("count"))


# ---------------------------------------------------------------------------
def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], *, group: Sequence[str] = (),
                    names: Sequence[str] | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (pandas / ``percentile``),
    NULLs ignored, one row per group.  Works from per-value counts and
    distributed running sums; no group's values are gathered."""
    group = list(group)
    names = list(names or [f"q{int(round(p * 100))}" for p in probs])
    base = df.where(F.col(col).isNotNull())
    counts = base.groupBy(*group, col).agg(F.count(F.lit(1)).alias("_t"))
    cum = global_cumsum(counts, [col], ["_t"], group=group)
    totals = counts.groupBy(*group).agg(F.sum("_t").alias("_n"))
    if group:
        j = join_null_safe(cum, totals, group)
    else:
        j = cum.withColumn("_n", F.lit(totals.first()["_n"]))      # one number
    lo_hi = []
    for p in probs:
        h = (F.col("_n") - F.lit(1)) * F.lit(float(p))
        lo, hi = F.floor(h), F.ceil(h)
        start = F.col("cum__t") - F.col("_t")        # 0-based first position of this value
        end = F.col("cum__t")                        # exclusive
        lo_hi.append((h, lo, hi, start, end))
    # Only the value rows holding a needed order statistic reach the final aggregate.
    needed = None
    for h, lo, hi, start, end in lo_hi:
        c = ((lo >= start) & (lo < end)) | ((hi >= start) & (hi < end))
        needed = c if needed is None else needed | c
    j = j.where(needed)
    aggs = []
    for (h, lo, hi, start, end), name in zip(lo_hi, names):
        v_lo = F.max(F.when((lo >= start) & (lo < end), F.col(col)))
        v_hi = F.max(F.when((hi >= start) & (hi < end), F.col(col)))
        frac = F.max(h - lo)
        aggs.append((v_lo + (v_hi - v_lo) * frac).cast("double").alias(name))
    return j.groupBy(*group).agg(*aggs)


def column_medians(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Exact median of every column in one distributed job: the columns are
    unpivoted to (column, value) rows and ``exact_quantiles`` runs grouped by
    column.  Result: one row per column (bounded by the column count)."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("_c"), F.col(c).cast("double").alias("_v"))
                                         for c in cols])).alias("_kv")).select("_kv._c", "_kv._v")
    return exact_quantiles(long, "_v", [0.5], group=["_c"], names=["median"])


def impute_median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fill NULLs of each column with that column's exact global median.

    The per-column medians (one number per column) are the only values that
    reach the driver; they are applied as literals.
    """
    meds = {r["_c"]: r["median"] for r in column_medians(df, cols).collect()}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(meds.get(c)).cast("double")) for c in cols})


# ---------------------------------------------------------------------------
def summary_categorical(df: DataFrame, cats: Sequence[str], by: str, *, overall: str = "Overall",
                        limit: int | None = None) -> DataFrame:
    """n and % per level of each categorical column, per group and overall.

    Rows: variable, level, grp, n, pct (percent of non-missing in the group).
    ``limit`` keeps the most frequent levels overall (ties by level).
    """
    out = None
    for c in cats:
        base = df.where(F.col(c).isNotNull()).select(F.lit(c).alias("variable"),
                                                      F.col(c).cast("string").alias("level"),
                                                      F.col(by).cast("string").alias("grp"))
        per = base.groupBy("variable", "level", "grp").agg(F.count(F.lit(1)).alias("n"))
        tot = per.groupBy("variable", "level").agg(F.sum("n").alias("n")).withColumn("grp", F.lit(overall))
        both = per.unionByName(tot.select("variable", "level", "grp", "n"))
        w = Window.partitionBy("variable", "grp")
        both = both.withColumn("pct", (F.col("n") * F.lit(100.0) / F.sum("n").over(w)).cast("double"))
        if limit is not None:
            # A top-k report: each task keeps ``limit`` levels, which are merged.
            rank = tot.orderBy(F.col("n").desc(), F.col("level")).limit(limit).select("variable", "level")
            both = both.join(rank, ["variable", "level"], "left_semi")
        out = both if out is None else out.unionByName(both)
    return out.select("variable", "level", "grp", F.col("n").cast("long").alias("n"), "pct")


def summary_numeric(df: DataFrame, nums: Sequence[str], by: str, *, overall: str = "Overall") -> DataFrame:
    """median [Q1, Q3] and n per numeric column, per group and overall."""
    out = None
    for c in nums:
        base = df.select(F.col(c).cast("double").alias("_v"), F.col(by).cast("string").alias("grp"))
        everyone = base.withColumn("grp", F.lit(overall))
        both = base.unionByName(everyone)
        q = exact_quantiles(both, "_v", [0.25, 0.5, 0.75], group=["grp"], names=["q1", "median", "q3"])
        n = both.where(F.col("_v").isNotNull()).groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
        r = q.join(n, "grp").select(F.lit(c).alias("variable"), "grp", "n", "median", "q1", "q3")
        out = r if out is None else out.unionByName(r)
    return out


def chi2_stat(df: DataFrame, col: str, by: str, *, yates: bool = True) -> DataFrame:
    """Chi-square test of independence between ``col`` and ``by`` (NULLs dropped).

    One row: variable, statistic, dof.  With one degree of freedom the Yates
    continuity correction is applied (never larger than |O - E|), as the
    usual scientific-python routine does.  Row and column totals are
    aggregates joined back to the observed cells.  Empty cells need no row of
    their own: their expected counts add up to what the observed cells lack of
    the total.  No rows at all give a NULL statistic and NULL dof.
    """
    base = df.where(F.col(col).isNotNull() & F.col(by).isNotNull()).select(
        F.col(col).cast("string").alias("_lvl"), F.col(by).cast("string").alias("_grp"))
    obs = base.groupBy("_lvl", "_grp").agg(F.count(F.lit(1)).alias("o"))
    rows = obs.groupBy("_lvl").agg(F.sum("o").cast("double").alias("rt"))
    cols = obs.groupBy("_grp").agg(F.sum("o").cast("double").alias("ct"))
    n = F.col("_all.n")
    whole = rows.agg(F.struct(F.sum("rt").alias("n"), F.count(F.lit(1)).alias("k"))).scalar()
    groups = cols.agg(F.count(F.lit(1))).scalar()
    cells = obs.join(rows, "_lvl").join(cols, "_grp").withColumn("_all", whole)
    e, o = F.col("rt") * F.col("ct") / n, F.col("o").cast("double")
    diff = F.abs(o - e)
    sums = cells.agg(F.sum(diff * diff / e).alias("seen"), F.sum(e).alias("expected"),
                     F.min(diff).alias("diff"), F.max(n).alias("n"), F.max("_all.k").alias("levels"))
    dof = ((F.col("levels") - F.lit(1)) * (groups - F.lit(1))).cast("long")
    return _chi2_of(sums.withColumn("dof", dof), col, yates)


def _chi2_of(sums: DataFrame, col: str, yates: bool) -> DataFrame:
    """Statistic from the sums over observed cells; empty cells add their expected counts."""
    plain = F.col("seen") + F.greatest(F.col("n") - F.col("expected"), F.lit(0.0))
    stat = plain
    if yates:
        # In a 2 x 2 table every |o - e| is the same d, and sum (d - c)^2 / e scales the plain sum.
        d = F.col("diff")
        left = d - F.least(F.lit(0.5), d)
        stat = F.when((F.col("dof") == 1) & (d > 0), plain * left * left / (d * d)).otherwise(plain)
    return sums.select(F.lit(col).alias("variable"), stat.alias("statistic"), "dof")


def kruskal_stat(df: DataFrame, col: str, by: str) -> DataFrame:
    """Kruskal-Wallis H (tie-corrected) of ``col`` across groups of ``by``.

    Average ranks come from per-value counts and a distributed running sum;
    rank sums per group are one more aggregate.  One row: variable,
    statistic, dof.
    """
    base = df.where(F.col(col).isNotNull() & F.col(by).isNotNull()).select(
        F.col(col).cast("double").alias("_v"), F.col(by).alias("_g"))
    per = base.groupBy("_v", "_g").agg(F.count(F.lit(1)).alias("_ng"))
    ties = per.groupBy("_v").agg(F.sum("_ng").alias("_t"))
    cum = global_cumsum(ties, ["_v"], ["_t"])
    ranked = cum.select("_v", "_t", (F.col("cum__t") - (F.col("_t") - F.lit(1)) / F.lit(2.0)).alias("_rk"))
    j = per.join(ranked, "_v")
    sums = j.groupBy("_g").agg(F.sum(F.col("_ng") * F.col("_rk")).alias("R"), F.sum("_ng").alias("n"))
    n_tot = F.sum("n")
    h = sums.agg((F.lit(12.0) / (n_tot * (n_tot + 1)) * F.sum(F.col("R") * F.col("R") / F.col("n"))
                  - F.lit(3.0) * (n_tot + 1)).alias("h"), F.count(F.lit(1)).alias("k"),
                 n_tot.cast("double").alias("N"))
    tie_sum = ties.agg(F.sum(F.col("_t").cast("double") ** 3 - F.col("_t")).alias("ts"))
    corr = F.lit(1.0) - tie_sum.select("ts").scalar() / (F.col("N") ** 3 - F.col("N"))
    return h.select(F.lit(col).alias("variable"), (F.col("h") / corr).alias("statistic"),
                    (F.col("k") - 1).cast("long").alias("dof"))


def chi2_pvalue(stat: Column, dof: Column) -> Column:
    """Upper tail of the chi-square distribution (see ``functions.pvalue``)."""
    from wardline.functions.pvalue import chi2_sf

    return chi2_sf(stat.cast("double"), dof.cast("long"))
