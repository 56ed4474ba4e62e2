"""Cohort operators: base cohort with exclusion flags, onset detection,
cases, controls, static features and demographics.

Composite builders read tables with the column names of the clinical
schema (see FIXTURES.md §1); generic helpers take column names.

Scale notes: "first row per key" is an aggregate (``min`` of a struct
whose leading fields are the sort key), so it is combined map-side and a
hot key never gathers its rows into one window task; per-key sequence
numbers use windows partitioned by the key (stays per patient and
admissions per patient are small by nature).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline import specs
from wardline.functions.scalar import topcode
from wardline.functions.temporal import (add_hours, diff_days, diff_days_elapsed, diff_hours,
                                         diff_hours_boundary, diff_seconds, diff_years)
from wardline.operators.joins import exclude, not_in


def _list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def first_per_key(df: DataFrame, keys, order, cols: Sequence[str] | None = None) -> DataFrame:
    """First row per key in ``order`` (ascending, NULLs first; ties broken by the
    remaining columns), as an aggregate with map-side combine."""
    keys, order = _list(keys), _list(order)
    cols = [c for c in (cols or df.columns) if c not in keys]
    rest = [c for c in cols if c not in order]
    packed = F.min(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest])).alias("_first")
    return df.groupBy(*keys).agg(packed).select(*keys, *[F.col(f"_first.{c}").alias(c) for c in cols])


def order_number(df: DataFrame, keys, order, name: str = "rn") -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order)`` (order must be total)."""
    w = Window.partitionBy(*_list(keys)).orderBy(*[F.col(c).asc_nulls_first() for c in _list(order)])
    return df.withColumn(name, F.row_number().over(w))


def sequence_number(df: DataFrame, keys, order, name: str, flag: str | None = None) -> DataFrame:
    """``DENSE_RANK() OVER (PARTITION BY keys ORDER BY order)`` and an optional
    first-flag column (1 when the rank is 1)."""
    w = Window.partitionBy(*_list(keys)).orderBy(*[F.col(c).asc_nulls_first() for c in _list(order)])
    out = df.withColumn(name, F.dense_rank().over(w))
    if flag:
        out = out.withColumn(flag, F.when(F.col(name) == 1, 1).otherwise(0))
    return out


def exclusion_flags(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One 0/1 column per rule; a NULL condition gives 0 (``CASE WHEN .. ELSE 0``)."""
    return df.withColumns({name: F.when(cond, F.lit(1)).otherwise(F.lit(0)) for name, cond in rules.items()})


def any_flag(conds: Sequence[Column]) -> Column:
    """``CASE WHEN c1 OR c2 ... THEN 1 ELSE 0 END``."""
    return F.when(reduce(lambda a, b: a | b, conds), F.lit(1)).otherwise(F.lit(0))


# ---------------------------------------------------------------------------
def build_cohort(icustays: DataFrame, admissions: DataFrame, patients: DataFrame,
                 services: DataFrame, suspicion: DataFrame, *,
                 surgical: Sequence[str] = tuple(specs.SURGICAL_SERVICES),
                 source: str = specs.SOURCE_SYSTEM, nonadult_age: float = 14,
                 topcode_above: float = specs.AGE_TOPCODE_ABOVE,
                 topcode_value: float = specs.AGE_TOPCODE_VALUE) -> DataFrame:
    """Base cohort: one row per ICU stay with age, suspicion columns and the
    exclusion flags (secondary stay, non-adult, surgical first service, source
    system, early/late suspicion, suspicion before intime + 4 h, bad data) and
    the combined ``excluded`` flag."""
    first_service = first_per_key(services.select("hadm_id", "transfertime", "curr_service"),
                                  "hadm_id", "transfertime").select(
        "hadm_id", F.col("curr_service").alias("first_service"))
    ie = icustays.select("icustay_id", "hadm_id", "subject_id", "intime", "outtime", "dbsource")
    adm = admissions.select("hadm_id", "admittime", "ethnicity", "has_chartevents_data")
    pat = patients.select("subject_id", "dob", "gender")
    sp = suspicion.select("icustay_id", "suspected_infection_time", "specimen",
                          "positiveculture", "antibiotic_time")
    stays = (ie.join(adm, "hadm_id").join(pat, "subject_id")
          .join(first_service, "hadm_id", "left")
          .join(sp, "icustay_id", "left"))
    # Stay order per subject over the joined rows (as the original numbers
    # them).  A window partitioned by subject: ICU stays per patient are a
    # naturally small group, and this keeps the cohort join single in the plan.
    stays = order_number(stays, "subject_id", ["intime", "icustay_id"], "_rn")
    age = F.round(diff_days("admittime", "dob").cast("double") / F.lit(specs.DAYS_PER_YEAR), 4)
    susp = F.col("suspected_infection_time")
    stays = stays.withColumn("_age", age).withColumn("_rn1", F.col("_rn") == 1)
    intime = F.col("intime")
    out = stays.select(
        "hadm_id", "icustay_id", "intime", "outtime",
        topcode(F.col("_age"), topcode_above, topcode_value).alias("age"),
        "gender", "ethnicity", "first_service", "dbsource",
        F.when(susp.isNotNull(), 1).otherwise(0).alias("suspected_of_infection_poe"),
        susp.alias("suspected_infection_time_poe"),
        diff_days_elapsed(intime, susp).alias("suspected_infection_time_poe_days"),
        F.col("specimen").alias("specimen_poe"),
        F.col("positiveculture").alias("positiveculture_poe"),
        F.col("antibiotic_time").alias("antibiotic_time_poe"),
        F.when(F.col("_rn1"), 0).otherwise(1).alias("exclusion_secondarystay"),
        F.when(F.col("_age") <= nonadult_age, 1).otherwise(0).alias("exclusion_nonadult"),
        F.when(F.col("first_service").isin(list(surgical)), 1).otherwise(0).alias("exclusion_csurg"),
        F.when(F.col("dbsource") != F.lit(source), 1).otherwise(0).alias("exclusion_carevue"),
        F.when(susp.isNotNull() & (susp < add_hours(intime, -24)), 1).otherwise(0)
         .alias("exclusion_early_suspicion"),
        F.when(susp.isNotNull() & (susp > add_hours(intime, 24)), 1).otherwise(0)
         .alias("exclusion_late_suspicion"),
        F.when(susp.isNotNull() & (susp < add_hours(intime, 4)), 1).otherwise(0)
         .alias("exclusion_suspicion_before_4_hours"),
        F.when(F.col("has_chartevents_data") == 0, 1).when(intime.isNull(), 1)
         .when(F.col("outtime").isNull(), 1).otherwise(0).alias("exclusion_bad_data"),
        any_flag([F.col("_age") <= nonadult_age, F.col("has_chartevents_data") == 0,
                  intime.isNull(), F.col("outtime").isNull(), F.col("dbsource") != F.lit(source),
                  susp.isNotNull() & (susp < add_hours(intime, 4))]).alias("excluded"),
    )
    return out


def detect_onset(scores: DataFrame, suspicion: DataFrame, *, key: str = "icustay_id",
                 start_col: str = "starttime", end_col: str = "endtime",
                 score_col: str = "sofa_24hours", susp_col: str = "suspected_infection_time",
                 lo_hours: int = -48, hi_hours: int = 24, threshold: float = 2) -> DataFrame:
    """Onset = end time of the first score row with ``score >= threshold`` whose
    start lies ``lo_hours..hi_hours`` hour boundaries from the suspicion time.

    Output: key, suspicion time, ``sepsis_onset``, score, ``row_id`` (= 1).
    Ties on the onset time are broken by the lower score.
    """
    sp = suspicion.select(key, susp_col).where(F.col(susp_col).isNotNull())
    crossed = (scores.select(key, start_col, end_col, score_col)
             .where(F.col(score_col) >= F.lit(threshold))
             .join(sp, key)
             .where(diff_hours_boundary(start_col, susp_col).between(lo_hours, hi_hours)))
    candidates = crossed.select(key, susp_col, F.col(end_col).alias("sepsis_onset"), score_col)
    first = first_per_key(candidates, key, ["sepsis_onset", score_col])
    return first.select(key, susp_col, "sepsis_onset", score_col, F.lit(1).cast("long").alias("row_id"))


def stay_frame(onsets: DataFrame, cohort: DataFrame, admissions: DataFrame, icustays: DataFrame) -> DataFrame:
    """What cases and controls are chosen from: every cohort stay with its onset (NULL without one),
    the admission's data flag and its subject.  Stored once, it serves both arms as filters."""
    c = cohort.select("icustay_id", "hadm_id", "intime", "outtime", "age", "dbsource", "suspected_of_infection_poe")
    return (c.join(onsets.select("icustay_id", "sepsis_onset"), "icustay_id", "left")
            .join(admissions.select("hadm_id", "has_chartevents_data"), "hadm_id")
            .join(icustays.select("icustay_id", "subject_id"), "icustay_id"))


def _unclean(min_age: float, source: str) -> list[Column]:
    return [F.col("age") <= min_age, F.col("has_chartevents_data") == 0, F.col("intime").isNull(),
            F.col("outtime").isNull(), F.col("dbsource") != F.lit(source)]


def select_cases(stays: DataFrame, *, min_age: float = 16, source: str = specs.SOURCE_SYSTEM) -> DataFrame:
    """Rows of ``stay_frame`` with an onset inside [intime, outtime] that pass the clean-data rules."""
    onset = F.col("sepsis_onset")
    kept = exclude(stays, [*_unclean(min_age, source), F.col("suspected_of_infection_poe") == 0,
                           onset > F.col("outtime"), onset < F.col("intime")])
    return kept.select(
        "icustay_id", "intime", "outtime",
        diff_hours("outtime", "intime").alias("length_of_stay"),
        "sepsis_onset",
        diff_days_elapsed(onset, "intime").alias("sepsis_onset_day"),
        diff_hours(onset, "intime").alias("sepsis_onset_hour"),
        "subject_id")


def select_controls(stays: DataFrame, diagnoses: DataFrame, *, codes: Sequence[str] = tuple(specs.SEPSIS_ICD9_CODES),
                    min_age: float = 16, source: str = specs.SOURCE_SYSTEM) -> DataFrame:
    """Rows of ``stay_frame`` without onset whose admission carries none of ``codes`` (NOT IN,
    null-aware) and that pass the clean-data rules."""
    dx = diagnoses.where(F.col("icd9_code").isin(list(codes))).select("hadm_id")
    kept = exclude(not_in(stays, "hadm_id", dx), [*_unclean(min_age, source), F.col("sepsis_onset").isNotNull()])
    return kept.select("icustay_id", "hadm_id", "intime", "outtime",
                       diff_hours("outtime", "intime").alias("length_of_stay"),
                       "sepsis_onset", "subject_id")


def build_cases(onsets: DataFrame, cohort: DataFrame, admissions: DataFrame, icustays: DataFrame, **rules) -> DataFrame:
    """Cases from their tables: ``select_cases`` of the ``stay_frame``."""
    return select_cases(stay_frame(onsets, cohort, admissions, icustays), **rules)


def build_controls(cohort: DataFrame, onsets: DataFrame, admissions: DataFrame, icustays: DataFrame,
                   diagnoses: DataFrame, **rules) -> DataFrame:
    """Controls from their tables: ``select_controls`` of the ``stay_frame``."""
    return select_controls(stay_frame(onsets, cohort, admissions, icustays), diagnoses, **rules)


def static_features(icustays: DataFrame, admissions: DataFrame, patients: DataFrame) -> DataFrame:
    """Per-stay static variables: gender, admission age (4 decimals), admission
    attributes, hospital-stay and ICU-stay sequence numbers and first flags."""
    adm = admissions.select("hadm_id", F.col("subject_id").alias("_adm_subject"), "admittime",
                            "ethnicity", "admission_type", "admission_location",
                            "has_chartevents_data").where(F.col("has_chartevents_data") == 1)
    j = (icustays.select("subject_id", "hadm_id", "icustay_id", "first_careunit", "intime", "outtime")
         .join(adm, "hadm_id").join(patients.select("subject_id", "gender", "dob"), "subject_id"))
    secs = diff_seconds("admittime", "dob").cast("double") / F.lit(specs.SECONDS_PER_YEAR)
    age = F.round(secs.cast("decimal(38,9)"), 4).cast("double")
    w_h = Window.partitionBy("_adm_subject").orderBy(F.col("admittime").asc_nulls_first())
    w_i = Window.partitionBy("hadm_id").orderBy(F.col("intime").asc_nulls_first())
    hs = F.dense_rank().over(w_h)
    ics = F.dense_rank().over(w_i)
    return j.select(
        "subject_id", "hadm_id", "icustay_id", "gender", "admittime",
        age.alias("admission_age"), "ethnicity", "admission_type", "admission_location",
        "first_careunit", hs.cast("long").alias("hospstay_seq"),
        F.when(hs == 1, 1).otherwise(0).alias("first_hosp_stay"),
        "intime", "outtime", ics.cast("long").alias("icustay_seq"),
        F.when(ics == 1, 1).otherwise(0).alias("first_icu_stay"))


def demographics(patients: DataFrame, admissions: DataFrame, diagnoses: DataFrame, *,
                 with_dx: bool = True, codes: Sequence[str] = tuple(specs.SEPSIS_ICD9_CODES)) -> DataFrame:
    """Demographics of subjects with (or without) any of ``codes``: total length
    of stay in days (midnights), first admission time and the admission
    attributes (several rows per subject when they vary), age at first
    admission and at death in year boundaries."""
    dx = diagnoses.where(F.col("icd9_code").isin(list(codes))).select("subject_id").distinct()
    pat = patients.select("subject_id", "dob", "dod", "gender")
    pat = pat.join(dx, "subject_id", "left_semi" if with_dx else "left_anti").distinct()
    los = admissions.groupBy("subject_id").agg(
        F.sum(diff_days("dischtime", "admittime")).alias("los"))
    first_admit = admissions.groupBy("subject_id").agg(F.min("admittime").alias("admit_time"))
    attrs = admissions.select("subject_id", "ethnicity", "marital_status", "insurance").distinct()
    demo = attrs.join(first_admit, "subject_id").join(los, "subject_id")
    out = pat.join(demo, "subject_id").select(
        "subject_id", "gender", "dob", "dod", "ethnicity", "marital_status", "insurance",
        "los", "admit_time").distinct()
    return out.withColumns({"age_admit": diff_years("admit_time", "dob"),
                            "age_death": diff_years("dod", "dob")})
