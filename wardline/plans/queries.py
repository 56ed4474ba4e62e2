"""Registered queries: each binds the operators to the driver's tables.

Every query reads the whole test tables (via ``Testbed``) and returns a lazy
DataFrame.  Small reused intermediates (anchors) are checkpointed into the
session's checkpoint directory so that size checks are cheap and lineage is
cut before the big interval joins.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.operators import cohort as C
from wardline.operators.measures import lab_events_before, measure_series, measured_keys, stack_anchors
from wardline.plans.testbed import DIAGNOSIS_CODES, SURGICAL, Testbed, lab_spec, vital_spec
from wardline.session import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------------------
# shared building blocks
def cohort_of(tb: Testbed) -> DataFrame:
    return C.build_cohort(tb.icustays, tb.admissions, tb.patients, tb.services, tb.suspicion,
                          surgical=SURGICAL)


def onsets_of(tb: Testbed) -> DataFrame:
    return C.detect_onset(tb.scores, tb.suspicion)


def cases_of(tb: Testbed) -> DataFrame:
    return C.build_cases(onsets_of(tb), cohort_of(tb), tb.admissions, tb.icustays)


def controls_of(tb: Testbed) -> DataFrame:
    return C.build_controls(cohort_of(tb), onsets_of(tb), tb.admissions, tb.icustays,
                            tb.diagnoses, codes=DIAGNOSIS_CODES)


def stays_m(tb: Testbed) -> DataFrame:
    """Cohort stays with onset, subject and data flag, checkpointed once per query: cases and
    controls are filters of it."""
    def build():
        # Stays and admissions are read several times below: they are derived once.
        tb.icustays, tb.admissions = materialize(tb.icustays), materialize(tb.admissions)
        return materialize(C.stay_frame(onsets_of(tb), cohort_of(tb), tb.admissions, tb.icustays))
    return tb.memo("stays", build)


def cases_m(tb: Testbed) -> DataFrame:
    return tb.memo("cases", lambda: C.select_cases(stays_m(tb)))


def controls_m(tb: Testbed) -> DataFrame:
    return tb.memo("controls", lambda: C.select_controls(stays_m(tb), tb.diagnoses, codes=DIAGNOSIS_CODES))


def series_anchors(tb: Testbed, anchors: DataFrame, anchor_col: str) -> DataFrame:
    """Anchor stays with their subject and admission, checkpointed once per
    query and shared by the lab and vital extractions (the anchor column names
    the arm: onsets are the cases', assigned onsets the matched controls')."""
    def build():
        a = anchors.select("icustay_id", anchor_col).join(
            stays_m(tb).select("icustay_id", "subject_id", "hadm_id"), "icustay_id", "left")
        return materialize(a)
    return tb.memo(f"anchors:{anchor_col}", build)


def lab_series(tb: Testbed, anchors: DataFrame, anchor_col: str, hours: int) -> DataFrame:
    a = series_anchors(tb, anchors, anchor_col)
    return measure_series(a, tb.labevents, lab_spec(), keys=["subject_id", "hadm_id"],
                          anchor_col=anchor_col, time_col="charttime", hours=hours)


def vital_series(tb: Testbed, anchors: DataFrame, anchor_col: str, hours: int) -> DataFrame:
    a = series_anchors(tb, anchors, anchor_col)
    return measure_series(a, tb.chartevents, vital_spec(), keys="icustay_id",
                          anchor_col=anchor_col, time_col="charttime", hours=hours,
                          event_filter=F.col("error") == 0)


ANCHOR_TAGS = ["label", "horizon", "icustay_id", "subject_id", "anchor_time"]


def both_arms(tb: Testbed, horizons: tuple[int, ...] = (48,)) -> DataFrame:
    """Cases (label 1, anchored at onset) and matched controls (label 0, at the assigned
    onset) with their subject and admission, one row per horizon, built once per query."""
    def build():
        ids = stays_m(tb).select("icustay_id", "subject_id", "hadm_id")
        arms = [(cases_m(tb).select("icustay_id", "sepsis_onset"), "sepsis_onset", {"label": 1}),
                (matched_of(tb).select("icustay_id", "control_onset_time"), "control_onset_time", {"label": 0})]
        return materialize(stack_anchors(arms, horizons).join(ids, "icustay_id", "left"))
    return tb.memo(f"both_arms:{horizons}", build)


def both_labs(tb: Testbed, horizons: tuple[int, ...] = (48,), how: str = "left") -> DataFrame:
    """Lab series of all arms and horizons: one scan of the lab log."""
    return measure_series(both_arms(tb, horizons), tb.labevents, lab_spec(), keys=["subject_id", "hadm_id"],
                          anchor_col="anchor_time", time_col="charttime", hours="horizon", how=how, keep=ANCHOR_TAGS)


def both_vitals(tb: Testbed, horizons: tuple[int, ...] = (48,)) -> DataFrame:
    """Vital series of all arms and horizons: one scan of the chart log."""
    return measure_series(both_arms(tb, horizons), tb.chartevents, vital_spec(), keys="icustay_id",
                          anchor_col="anchor_time", time_col="charttime", hours="horizon", keep=ANCHOR_TAGS,
                          event_filter=F.col("error") == 0)


def with_measurements(tb: Testbed, how_many_hours: int = 48) -> list[DataFrame]:
    """(label, subject_id) of the anchors that have labs, and of those that have vitals."""
    common = {"anchor_col": "anchor_time", "time_col": "charttime", "hours": "horizon", "keep": ["label", "subject_id"]}
    anchors = both_arms(tb, (how_many_hours,))
    return [measured_keys(anchors, tb.labevents, lab_spec(), keys=["subject_id", "hadm_id"], **common),
            measured_keys(anchors, tb.chartevents, vital_spec(), keys="icustay_id", event_filter=F.col("error") == 0, **common)]


# ---------------------------------------------------------------------------
@query("base_cohort")
def q_base_cohort(spark, sf_dir):
    return cohort_of(Testbed(spark, sf_dir))


@query("detect_onset")
def q_detect_onset(spark, sf_dir):
    return onsets_of(Testbed(spark, sf_dir))


@query("build_cases")
def q_build_cases(spark, sf_dir):
    return cases_of(Testbed(spark, sf_dir))


@query("build_controls")
def q_build_controls(spark, sf_dir):
    return controls_of(Testbed(spark, sf_dir))


def _series(kind: str, hours: int):
    def run(spark, sf_dir):
        tb = Testbed(spark, sf_dir)
        fn = lab_series if kind == "lab" else vital_series
        return fn(tb, cases_m(tb), "sepsis_onset", hours)
    return run


for _kind in ("lab", "vital"):
    for _h in (48, 96):
        QUERIES[f"{_kind}_series_case_{_h}h"] = _series(_kind, _h)


# ---------------------------------------------------------------------------
from wardline.operators.joins import window_join  # noqa: E402
from wardline.operators.matching import match_controls, match_ratio  # noqa: E402
from wardline.specs import LabelSpec  # noqa: E402

MATCH_SEED = 42
MATCHED_COLUMNS = ["icustay_id", "hadm_id", "intime", "outtime", "length_of_stay", "subject_id",
                   "control_onset_time", "control_onset_hour", "matched_case_icustay_id"]


def matched_lazy(tb: Testbed) -> DataFrame:
    m = match_controls(cases_m(tb), controls_m(tb), seed=MATCH_SEED)
    # Stored schema of the matched-controls table: onset column projected out.
    return m.select(*MATCHED_COLUMNS)


def matched_of(tb: Testbed) -> DataFrame:
    """Matched controls, checkpointed once per query (anchors of later steps)."""
    return tb.memo("matched", lambda: materialize(matched_lazy(tb)))


@query("match_controls")
def q_match_controls(spark, sf_dir):
    return matched_lazy(Testbed(spark, sf_dir))


@query("match_ratio")
def q_match_ratio(spark, sf_dir):
    tb = Testbed(spark, sf_dir)
    return match_ratio(cases_m(tb), controls_m(tb), matched_of(tb))


def _control_series(kind: str, hours: int):
    def run(spark, sf_dir):
        tb = Testbed(spark, sf_dir)
        fn = lab_series if kind == "lab" else vital_series
        return fn(tb, matched_of(tb), "control_onset_time", hours)
    return run


def _all_series(kind: str):
    def run(spark, sf_dir):
        tb = Testbed(spark, sf_dir)
        return both_labs(tb, (48, 96)) if kind == "lab" else both_vitals(tb, (48, 96))
    return run


# All arms and look-back lengths from one join each; the eight series above are filters of these.
for _kind in ("lab", "vital"):
    QUERIES[f"{_kind}_series_all"] = _all_series(_kind)


for _kind in ("lab", "vital"):
    for _h in (48, 96):
        QUERIES[f"{_kind}_series_control_{_h}h"] = _control_series(_kind, _h)


def hourly_lab_spec_test() -> LabelSpec:
    """Long-form spec of the test items, of which some stay unlabelled (the clinical table
    ``specs.hourly_lab_spec`` labels all of its items)."""
    spec = lab_spec()
    labelled = [(i, lab) for i, lab in spec.labels if i < 1020]
    return LabelSpec(labelled, spec.bounds, [], [i for i, _ in spec.labels if i >= 1020])


@query("lab_events_before")
def q_lab_events_before(spark, sf_dir):
    tb = Testbed(spark, sf_dir)
    anchors = tb.suspicion.select("icustay_id", "suspected_infection_time").join(
        tb.icustays.select("icustay_id", "hadm_id"), "icustay_id")
    anchors = materialize(anchors)
    return lab_events_before(anchors, tb.labevents, hourly_lab_spec_test(), keys="hadm_id",
                             anchor_col="suspected_infection_time", time_col="charttime", hours=48)


@query("window_join_48h")
def q_window_join_48h(spark, sf_dir):
    tb = Testbed(spark, sf_dir)
    anchors = materialize(tb.suspicion.select("icustay_id", "suspected_infection_time").join(
        tb.icustays.select("icustay_id", "subject_id", "hadm_id"), "icustay_id"))
    ev = tb.labevents.select("subject_id", "hadm_id", "charttime", "itemid", "valuenum")
    return window_join(anchors, ev, ["subject_id", "hadm_id"], "suspected_infection_time",
                       "charttime", 48, how="left")


# register the remaining families
import wardline.plans.queries_features  # noqa: E402,F401
