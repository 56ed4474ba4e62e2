"""Case-control matching (seeded, reproducible, fully distributed).

Controls are put in a seeded pseudo-random order (``md5(seed|id)``, the same
order in any engine), cases in id order.  With N cases and M controls the
original slices the shuffled controls into ``[int(i*M/N), int((i+1)*M/N))``
for case i.  Control j therefore belongs to the case

    i = ceil((j + 1) * N / M) - 1 = ((j + 1) * N + M - 1) div M - 1

so matching is two distributed indexes and one equi join: no loop, no
range join, and every control is assigned exactly once (the original's
float slicing can lose one row).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from wardline.functions.temporal import add_fractional_hours
from wardline.operators.indexing import range_index
from wardline.session import materialize
from wardline.sources.io import save_with_schema


def seeded_order_key(id_col: str, seed: int) -> F.Column:
    """Seeded permutation key ``md5('<seed>|<id>')`` (lowercase hex)."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(id_col).cast("string")))


def shuffled_index(df: DataFrame, id_col: str, seed: int, name: str = "idx", rows: int | None = None) -> DataFrame:
    """0-based position in the seeded random order (ties on the hash by id); ``rows`` as for ``range_index``."""
    keyed = df.withColumn("_h", seeded_order_key(id_col, seed))
    return range_index(keyed, ["_h", id_col], name=name, rows=rows).drop("_h")


def assign_controls(cases: DataFrame, controls: DataFrame, *, seed: int = 42, id_col: str = "icustay_id",
                    onset_hour_col: str = "sepsis_onset_hour", intime_col: str = "intime") -> DataFrame:
    """Every control with its case: the control columns, ``control_onset_hour``, ``control_onset_time``
    (= intime + onset hours), ``matched_case_icustay_id`` and ``n_controls``, their number.

    Without any case no control has a case and there are no rows.
    """
    # Rows are what is indexed, so rows are what is counted; either side is stored once and counted there.
    ctrl = materialize(controls.distinct())
    case = materialize(cases.select(F.col(id_col).alias("matched_case_icustay_id"), F.col(onset_hour_col).alias("control_onset_hour")))
    n_ctrl, n_case = ctrl.count(), case.count()
    cj = shuffled_index(ctrl, id_col, seed, "_j", n_ctrl)
    place = f"(cast(_j + 1 as decimal(19, 0)) * {n_case} + {n_ctrl} - 1) div {max(n_ctrl, 1)} - 1"
    cj = cj.withColumns({"_i": F.expr(place).cast("long"), "n_controls": F.lit(n_ctrl).cast("long")})
    ci = range_index(case, ["matched_case_icustay_id"], name="_i", rows=n_case)
    m = cj.join(ci, "_i")
    m = m.withColumn("control_onset_time", add_fractional_hours(intime_col, "control_onset_hour"))
    return m.select(*ctrl.columns, "control_onset_hour", "control_onset_time", "matched_case_icustay_id", "n_controls")


def match_controls(cases: DataFrame, controls: DataFrame, *, los_col: str = "length_of_stay", **kw) -> DataFrame:
    """Assign every control to one case; the control inherits the case's onset hour.

    Controls whose onset hour is not below their length of stay are dropped after the assignment
    (``assign_controls``, which takes the other arguments).
    """
    m = assign_controls(cases, controls, **kw)
    return m.where(F.col("control_onset_hour") < F.col(los_col)).drop("n_controls")


def write_matched(cases: DataFrame, controls: DataFrame, target: str, schema, *, los_col: str = "length_of_stay", **kw) -> int:
    """Store the matched controls with the declared schema; returns how many were assigned.

    The write observes how many controls it assigned and raises if that is not every one of them.
    Only then are those dropped whose onset would fall after discharge.
    """
    assigned = Observation()
    m = assign_controls(cases, controls, **kw).observe(
        assigned, F.count(F.lit(1)).alias("n"), F.max("n_controls").alias("wanted"))
    save_with_schema(m.where(F.col("control_onset_hour") < F.col(los_col)), target, schema)
    n = assigned.get["n"]
    wanted = assigned.get["wanted"] if n else controls.distinct().count()  # no row, no number
    if n != wanted:
        raise ValueError(f"{n} controls were assigned, expected {wanted}")
    return n


def match_ratio(cases: DataFrame, controls: DataFrame, matched: DataFrame,
                id_col: str = "icustay_id") -> DataFrame:
    """One row: distinct cases, distinct controls, their ratio, matched rows."""
    return matched.sparkSession.range(1).select(
        cases.select(F.count_distinct(id_col)).scalar().alias("n_cases"),
        controls.select(F.count_distinct(id_col)).scalar().alias("n_controls"),
        (controls.select(F.count_distinct(id_col)).scalar().cast("double")
         / cases.select(F.count_distinct(id_col)).scalar()).alias("ratio"),
        matched.select(F.count(F.lit(1))).scalar().alias("n_matched"))
