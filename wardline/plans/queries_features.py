"""Registered queries for aggregates, features, evaluation and set/join forms."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from wardline import specs
from wardline.functions import scalar as S
from wardline.functions import temporal as T
from wardline.operators import aggregates as A
from wardline.operators import evaluate as V
from wardline.operators import features as X
from wardline.operators.cohort import demographics, first_per_key, static_features
from wardline.operators.joins import anti, concat, not_in, outer_merge, semi_all
from wardline.operators.indexing import avg_rank
from wardline.operators.matching import write_matched
from wardline.operators.measures import lab_events_before, measure_series
from wardline.plans.queries import (QUERIES, both_labs, both_vitals, cases_m, cases_of, controls_m, controls_of, lab_series,
                                    matched_of, query, series_anchors, vital_series, with_measurements)
from wardline.plans.testbed import (DIAGNOSIS_CODES, SEGMENT_DEFAULT, SEGMENT_KEYWORDS, TEST_PANELS,
                                    Testbed)
from wardline.functions.scalar import recode_contains
from wardline.session import materialize
from wardline.sources.io import load_csv, load_table, save, save_bucketed, save_csv, scratch_path

LAB_COLS = ["C0", "C1", "C2", "C3", "C4", "V0", "V1", "V2"]
VIT_COLS = ["HeartRate", "SpO2", "TempC", "SVV", "FiO2"]
SEED = 42


def rounded(df: DataFrame, cols, digits: int = 6) -> DataFrame:
    """Round doubles whose last digits depend on summation order."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


# ---------------------------------------------------------------------------
# aggregates
@query("group_stats")
def q_group_stats(spark, sf_dir):
    tb = Testbed(spark, sf_dir)
    items = tb.lab_dictionary.where(F.lower("label").like("%econ%")).select("itemid")
    ev = tb.panel_events.join(items, "itemid", "left_semi")
    out = A.group_stats(ev, "subject_id", "valuenum", "econ")
    return rounded(out, ["econ_avg", "econ_stddev"])


@query("panel_stats")
def q_panel_stats(spark, sf_dir):
    tb = Testbed(spark, sf_dir)
    out = A.panel_stats(tb.panel_events, tb.lab_dictionary, TEST_PANELS)
    return rounded(out, [f"{p[0]}_{s}" for p in TEST_PANELS for s in ("avg", "stddev")])


def case_lab_series(tb: Testbed) -> DataFrame:
    return lab_series(tb, cases_m(tb), "sepsis_onset", 48)


@query("agg_features")
def q_agg_features(spark, sf_dir):
    tb = Testbed(spark, sf_dir)
    out = A.agg_features(case_lab_series(tb), "icustay_id", LAB_COLS, ("mean", "median", "std", "min", "max"))
    return rounded(out, [f"{c}_{s}" for c in LAB_COLS for s in ("mean", "std")])


def hourly(tb: Testbed, series: DataFrame, anchors: DataFrame, anchor_col: str, cols) -> DataFrame:
    """X1 + H14 + D4: hours before the anchor minus a 3 h horizon, reversed
    hour index 45 - ceil(h), mean per (stay, hour)."""
    s = series.join(anchors.select("icustay_id", anchor_col), "icustay_id")
    s = X.exclude_horizon(s, anchor_col, "chart_time", 3)
    s = s.withColumn("hr", S.reversed_hour_index("hr_feature", 45))
    return A.hourly_mean(s, "icustay_id", "hr", cols)


@query("hourly_mean")
def q_hourly_mean(spark, sf_dir):
    tb = Testbed(spark, sf_dir)
    cases = cases_m(tb)
    out = hourly(tb, lab_series(tb, cases, "sepsis_onset", 48), cases, "sepsis_onset", LAB_COLS)
    return rounded(out, LAB_COLS)


def merged_hourly(tb: Testbed, anchors: DataFrame, anchor_col: str) -> DataFrame:
    labs = hourly(tb, lab_series(tb, anchors, anchor_col, 48), anchors, anchor_col, LAB_COLS)
    vits = hourly(tb, vital_series(tb, anchors, anchor_col, 48), anchors, anchor_col, VIT_COLS)
    return outer_merge([labs, vits], ["icustay_id", "hr"])


@query("hourly_outer_merge")
def q_hourly_outer_merge(spark, sf_dir):
    tb = Testbed(spark, sf_dir)
    return rounded(merged_hourly(tb, cases_m(tb), "sepsis_onset"), LAB_COLS + VIT_COLS)


@query("forward_fill")
def q_forward_fill(spark, sf_dir):
    tb = Testbed(spark, sf_dir)
    m = merged_hourly(tb, cases_m(tb), "sepsis_onset")
    return rounded(X.forward_fill(m, "icustay_id", "hr", LAB_COLS + VIT_COLS, 0.0), LAB_COLS + VIT_COLS)


def sequence_frame(tb: Testbed) -> DataFrame:
    """Hourly labs + vitals of cases and matched controls, merged, filled,
    restricted to stays with both labs and vitals, with the label.

    One lab and one vital extraction serve both arms, one aggregate merges their hours,
    and the presence test reads the merged rows."""
    series = {"labs": (both_labs(tb, how="inner"), LAB_COLS), "vitals": (both_vitals(tb), VIT_COLS)}
    hours = {}
    for name, (rows, cols) in series.items():
        rows = X.exclude_horizon(rows, "anchor_time", "chart_time", 3)
        hours[name] = (rows.withColumn("hr", S.reversed_hour_index("hr_feature", 45)), cols)
    m = A.hourly_mean_all(hours, ["label", "icustay_id"], "hr")
    stay = Window.partitionBy("icustay_id")
    m = m.withColumns({f"_{n}": F.max(f"has_{n}").over(stay) for n in hours})
    m = m.where(" and ".join(f"_{n} = 1" for n in hours))
    m = m.select("icustay_id", "hr", *LAB_COLS, *VIT_COLS, "label")
    return X.forward_fill(m, "icustay_id", "hr", LAB_COLS + VIT_COLS, 0.0)


@query("sequence_frame")
def q_sequence_frame(spark, sf_dir):
    return rounded(sequence_frame(Testbed(spark, sf_dir)), LAB_COLS + VIT_COLS)


@query("sequences")
def q_sequences(spark, sf_dir):
    tb = Testbed(spark, sf_dir)
    sf = rounded(sequence_frame(tb), LAB_COLS + VIT_COLS)
    return X.assemble_sequences(sf, "icustay_id", "hr", LAB_COLS + VIT_COLS)


@query("padded_sequences")
def q_padded_sequences(spark, sf_dir):
    tb = Testbed(spark, sf_dir)
    sf = rounded(sequence_frame(tb), LAB_COLS + VIT_COLS)
    seqs = X.assemble_sequences(sf, "icustay_id", "hr", LAB_COLS + VIT_COLS)
    return X.pad_sequences(seqs, "icustay_id", batch_size=8, seed=SEED).select(
        "icustay_id", "batch", "pos", "length", "padded")


# ---------------------------------------------------------------------------
# static frames, recodes, Table 1
def static_of(tb: Testbed) -> DataFrame:
    return static_features(tb.icustays, tb.admissions, tb.patients)


@query("static_features")
def q_static_features(spark, sf_dir):
    return static_of(Testbed(spark, sf_dir))


@query("demographics_with")
def q_demographics_with(spark, sf_dir):
    tb = Testbed(spark, sf_dir)
    return demographics(tb.patients, tb.admissions, tb.diagnoses, with_dx=True, codes=DIAGNOSIS_CODES)


@query("demographics_without")
def q_demographics_without(spark, sf_dir):
    tb = Testbed(spark, sf_dir)
    return demographics(tb.patients, tb.admissions, tb.diagnoses, with_dx=False, codes=DIAGNOSIS_CODES)


def labelled_static(tb: Testbed) -> DataFrame:
    """Static rows of cases (label 1) and matched controls (label 0)."""
    arms = concat([cases_m(tb).select("icustay_id", F.lit(1).alias("label")),
                   matched_of(tb).select("icustay_id", F.lit(0).alias("label"))]).distinct()
    return static_of(tb).join(arms, "icustay_id")


def model_frame(tb: Testbed) -> DataFrame:
    """Static model frame (gender code, age, race dummies, label)."""
    both = labelled_static(tb).select(
        "gender", recode_contains(F.col("ethnicity"), SEGMENT_KEYWORDS, SEGMENT_DEFAULT).alias("ethnicity"),
        "admission_age", "icustay_id", "label")
    vocab = X.recode_vocab(SEGMENT_KEYWORDS, SEGMENT_DEFAULT)
    both = X.one_hot(both, "ethnicity", vocab)
    return X.label_encode(both, "gender")


@query("model_frame")
def q_model_frame(spark, sf_dir):
    tb = Testbed(spark, sf_dir)
    return X.stratified_split(model_frame(tb), "icustay_id", "label", 0.1, seed=SEED)


@query("recode_one_hot")
def q_recode_one_hot(spark, sf_dir):
    tb = Testbed(spark, sf_dir)
    c = tb.customer.select("c_custkey", F.col("c_mktsegment").alias("ethnicity"))
    c = c.withColumn("ethnicity", recode_contains(F.col("ethnicity"), SEGMENT_KEYWORDS, SEGMENT_DEFAULT))
    return X.one_hot(c, "ethnicity", X.recode_vocab(SEGMENT_KEYWORDS, SEGMENT_DEFAULT), drop=False)


@query("label_encode")
def q_label_encode(spark, sf_dir):
    tb = Testbed(spark, sf_dir)
    c = tb.customer.select("c_custkey", "c_mktsegment")
    return X.label_encode(c, "c_mktsegment", "segment_code").select("c_custkey", "c_mktsegment", "segment_code")


def summary_population(tb: Testbed) -> DataFrame:
    """First static row per subject (by age), subjects present in both the
    lab and vital series, case row wins over control row."""
    # A row per label and subject, then per subject with the case (label 1) first.
    first = first_per_key(labelled_static(tb).select("label", "subject_id", "admission_age", "gender", "ethnicity", "icustay_id"),
                          ["label", "subject_id"], ["admission_age", "icustay_id"])
    for present in with_measurements(tb):
        first = first.join(present, ["label", "subject_id"], "left_semi")
    both = first.select(
        "subject_id", "admission_age",
        S.binary_recode("gender", "F", "Female", "Male").alias("gender"),
        S.recode_contains(F.col("ethnicity"), SEGMENT_KEYWORDS, SEGMENT_DEFAULT).alias("ethnicity"),
        F.when(F.col("label") == 1, "Yes").otherwise("No").alias("sepsis"), (1 - F.col("label")).alias("_prio"))
    return first_per_key(both, "subject_id", ["_prio"]).drop("_prio")


@query("summary_population")
def q_summary_population(spark, sf_dir):
    return summary_population(Testbed(spark, sf_dir))


@query("summary_categorical")
def q_summary_categorical(spark, sf_dir):
    pop = materialize(summary_population(Testbed(spark, sf_dir)))
    return rounded(A.summary_categorical(pop, ["gender", "ethnicity"], "sepsis", limit=6), ["pct"])


@query("summary_numeric")
def q_summary_numeric(spark, sf_dir):
    pop = materialize(summary_population(Testbed(spark, sf_dir)))
    return A.summary_numeric(pop, ["admission_age"], "sepsis")


@query("chi2_stat")
def q_chi2_stat(spark, sf_dir):
    pop = materialize(summary_population(Testbed(spark, sf_dir)))
    return rounded(concat([A.chi2_stat(pop, "gender", "sepsis"), A.chi2_stat(pop, "ethnicity", "sepsis")]),
                   ["statistic"])


@query("kruskal_stat")
def q_kruskal_stat(spark, sf_dir):
    pop = materialize(summary_population(Testbed(spark, sf_dir)))
    return rounded(A.kruskal_stat(pop, "admission_age", "sepsis"), ["statistic"])


@query("summary_pvalues")
def q_summary_pvalues(spark, sf_dir):
    pop = materialize(summary_population(Testbed(spark, sf_dir)))
    stats = concat([A.chi2_stat(pop, "gender", "sepsis"), A.chi2_stat(pop, "ethnicity", "sepsis"),
                    A.kruskal_stat(pop, "admission_age", "sepsis")])
    stats = stats.withColumn("p_value", A.chi2_pvalue(F.col("statistic"), F.col("dof")))
    return rounded(stats, ["statistic", "p_value"])


# ---------------------------------------------------------------------------
# wide feature frame: imputation, scaling, sparse columns
def wide_features(tb: Testbed) -> DataFrame:
    return A.agg_features(case_lab_series(tb), "icustay_id", LAB_COLS, ("mean", "max"))


FEATS = [f"{c}_{s}" for c in LAB_COLS for s in ("mean", "max")]


@query("impute_median")
def q_impute_median(spark, sf_dir):
    w = materialize(wide_features(Testbed(spark, sf_dir)))
    return rounded(A.impute_median(w, FEATS), FEATS)


@query("minmax_scale")
def q_minmax_scale(spark, sf_dir):
    w = materialize(X.random_split(wide_features(Testbed(spark, sf_dir)), "icustay_id", 0.25, seed=0))
    stats = X.minmax_fit(w.where(F.col("is_test") == 0), FEATS)
    return rounded(X.minmax_apply(w, stats, FEATS), FEATS)


MEASURE_FEATS = [f"{c}_{s}" for c in LAB_COLS + VIT_COLS for s in ("mean", "median", "std")]


def stacked_frame(tb: Testbed) -> DataFrame:
    """C12 + D3 + G1: static rows of cases and of matched controls, each merged with the statistics of
    all labs and vitals of its subject in that arm, stacked with the label."""
    st = labelled_static(tb).select(
        "icustay_id", "subject_id", "label", "gender", "admission_age",
        recode_contains(F.col("ethnicity"), SEGMENT_KEYWORDS, SEGMENT_DEFAULT).alias("ethnicity"))
    labs = A.agg_features(both_labs(tb), ["label", "subject_id"], LAB_COLS)
    vits = A.agg_features(both_vitals(tb), ["label", "subject_id"], VIT_COLS)
    return st.join(labs, ["label", "subject_id"]).join(vits, ["label", "subject_id"]).drop("subject_id")


@query("static_measure_merge_arms")
def q_static_measure_merge_arms(spark, sf_dir):
    return rounded(stacked_frame(Testbed(spark, sf_dir)), MEASURE_FEATS)


def stacked_measures(tb: Testbed) -> DataFrame:
    return stacked_frame(tb).select("icustay_id", "label", *MEASURE_FEATS)


@query("impute_median_arms")
def q_impute_median_arms(spark, sf_dir):
    w = materialize(stacked_measures(Testbed(spark, sf_dir)))
    return rounded(A.impute_median(w, MEASURE_FEATS), MEASURE_FEATS)


@query("minmax_scale_arms")
def q_minmax_scale_arms(spark, sf_dir):
    w = materialize(X.random_split(stacked_measures(Testbed(spark, sf_dir)), "icustay_id", 0.25, seed=0))
    stats = X.minmax_fit(w.where(F.col("is_test") == 0), MEASURE_FEATS)
    return rounded(X.minmax_apply(w, stats, MEASURE_FEATS), MEASURE_FEATS)


@query("drop_sparse")
def q_drop_sparse(spark, sf_dir):
    w = materialize(stacked_measures(Testbed(spark, sf_dir)))
    out = X.drop_sparse(w, MEASURE_FEATS, 0.5)
    return rounded(out, [c for c in MEASURE_FEATS if c in out.columns])


@query("static_measure_merge")
def q_static_measure_merge(spark, sf_dir):
    tb = Testbed(spark, sf_dir)
    cases = cases_m(tb)
    st = static_of(tb).join(cases.select("icustay_id"), "icustay_id", "left_semi")
    labs = A.agg_features(lab_series(tb, cases, "sepsis_onset", 48), "icustay_id", ["C0", "V0"], ("mean",))
    vits = A.agg_features(vital_series(tb, cases, "sepsis_onset", 48), "icustay_id", ["HeartRate"], ("mean",))
    out = st.select("icustay_id", "gender", "admission_age").join(labs, "icustay_id").join(vits, "icustay_id")
    return rounded(out, ["C0_mean", "V0_mean", "HeartRate_mean"])


# ---------------------------------------------------------------------------
# splits and folds (labels)
@query("stratified_split")
def q_stratified_split(spark, sf_dir):
    tb = Testbed(spark, sf_dir)
    return X.stratified_split(tb.table("labels"), "doc_id", "quality", 0.1, seed=SEED)


@query("random_split")
def q_random_split(spark, sf_dir):
    tb = Testbed(spark, sf_dir)
    return X.random_split(tb.table("labels"), "doc_id", 0.25, seed=0)


@query("stratified_folds")
def q_stratified_folds(spark, sf_dir):
    tb = Testbed(spark, sf_dir)
    return X.stratified_folds(tb.table("labels"), "doc_id", "quality", 5, seed=SEED)


# ---------------------------------------------------------------------------
# evaluation (labels + documents)
@query("threshold_metrics")
def q_threshold_metrics(spark, sf_dir):
    return rounded(V.threshold_metrics(Testbed(spark, sf_dir).scored, "y", "p"),
                   ["accuracy", "precision", "recall", "f1"], 9)


@query("roc_curve")
def q_roc_curve(spark, sf_dir):
    return rounded(V.roc_curve(Testbed(spark, sf_dir).scored, "y", "p"), ["fpr", "tpr"], 9)


@query("roc_auc")
def q_roc_auc(spark, sf_dir):
    return rounded(V.roc_auc(Testbed(spark, sf_dir).scored, "y", "p"), ["roc_auc"], 9)


@query("pr_curve")
def q_pr_curve(spark, sf_dir):
    return rounded(V.pr_curve(Testbed(spark, sf_dir).scored, "y", "p"), ["recall", "precision"], 9)


@query("pr_auc")
def q_pr_auc(spark, sf_dir):
    return rounded(V.pr_auc(Testbed(spark, sf_dir).scored, "y", "p"), ["pr_auc"], 9)


@query("classification_metrics")
def q_classification_metrics(spark, sf_dir):
    m = V.classification_metrics(Testbed(spark, sf_dir).scored, "y", "p")
    return rounded(m, m.columns, 9)


def fold_predictions(tb: Testbed) -> DataFrame:
    """Five per-fold score variants of each labelled document (fold models)."""
    s = X.stratified_folds(tb.scored, "doc_id", "y", 5, seed=SEED)
    s = s.withColumn("model", F.explode(F.sequence(F.lit(0), F.lit(4))))
    shift = F.col("model").cast("double") * F.lit(100.0)
    n = F.col("p") * F.lit(2000.0) / (F.lit(1.0) - F.col("p"))
    return s.withColumn("p_model", (n + shift) / (n + shift + F.lit(2000.0)))


@query("ensemble_mean")
def q_ensemble_mean(spark, sf_dir):
    return rounded(V.ensemble_mean(fold_predictions(Testbed(spark, sf_dir)), "doc_id", "p_model"), ["p_mean"], 9)


@query("cv_band")
def q_cv_band(spark, sf_dir):
    out = V.cv_band(fold_predictions(Testbed(spark, sf_dir)), "model", "p_model")
    return rounded(out, ["mean", "sd", "lower", "upper"], 9)


@query("weighted_mean")
def q_weighted_mean(spark, sf_dir):
    li = Testbed(spark, sf_dir).table("lineitem")
    return rounded(V.weighted_mean(li, "l_extendedprice", "l_quantity", ["l_returnflag"]), ["weighted_mean"], 4)


@query("topk_sorted")
def q_topk_sorted(spark, sf_dir):
    li = Testbed(spark, sf_dir).table("lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return V.top_k(li, "l_extendedprice", 10, ["l_orderkey", "l_linenumber"])


# ---------------------------------------------------------------------------
# set and join forms
@query("not_in")
def q_not_in(spark, sf_dir):
    tb = Testbed(spark, sf_dir)
    urgent = tb.table("orders").where(F.col("o_orderpriority") == "1-URGENT") \
        .where(F.col("o_orderstatus") == "P").select("o_custkey")
    return not_in(tb.customer.select("c_custkey", "c_mktsegment"), "c_custkey", urgent, "o_custkey")


@query("anti_missing")
def q_anti_missing(spark, sf_dir):
    tb = Testbed(spark, sf_dir)
    dx = tb.diagnoses.where(F.col("icd9_code").isin(DIAGNOSIS_CODES)).select("subject_id").distinct()
    return anti(tb.patients.select("subject_id", "gender"), dx, "subject_id")


@query("semi_all")
def q_semi_all(spark, sf_dir):
    tb = Testbed(spark, sf_dir)
    ords = tb.table("orders").where(F.col("o_orderstatus") == "F").select("o_custkey")
    ev = tb.events.where(F.col("event_type") == "purchase").select("user_id")
    c = tb.customer.select("c_custkey", "c_name")
    return semi_all(semi_all(c, "c_custkey", [ords], "o_custkey"), "c_custkey", [ev], "user_id")


@query("concat_labelled")
def q_concat_labelled(spark, sf_dir):
    tb = Testbed(spark, sf_dir)
    c = cases_of(tb).withColumn("label", F.lit(1))
    k = controls_of(tb).withColumn("label", F.lit(0))
    return concat([c, k])


@query("value_counts")
def q_value_counts(spark, sf_dir):
    return A.value_counts(Testbed(spark, sf_dir).table("labels"), ["quality", "toxic"])


@query("distinct_keys")
def q_distinct_keys(spark, sf_dir):
    o = Testbed(spark, sf_dir).table("orders")
    return o.select("o_custkey", "o_orderpriority").distinct()


# ---------------------------------------------------------------------------
# scalar functions
@query("scalar_time")
def q_scalar_time(spark, sf_dir):
    tb = Testbed(spark, sf_dir)
    li = tb.table("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = tb.table("orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select(
        "l_orderkey", "l_linenumber",
        T.diff_seconds("l_shipdate", "o_orderdate").alias("d_seconds"),
        F.round(T.diff_hours("l_shipdate", "o_orderdate"), 6).alias("d_hours"),
        T.diff_hours_boundary("l_shipdate", "o_orderdate").alias("d_hour_boundaries"),
        T.diff_days("l_shipdate", "o_orderdate").alias("d_days"),
        T.diff_years("l_shipdate", "o_orderdate").alias("d_years"),
        T.add_hours("o_orderdate", -48).alias("minus_48h"),
        T.add_fractional_hours("o_orderdate", F.col("l_linenumber") * F.lit(1.25)).alias("plus_frac"),
        F.col("l_shipdate").between(T.add_hours("o_orderdate", 24 * 30), T.add_hours("o_orderdate", 24 * 90))
        .alias("ships_1_3_months"))


@query("scalar_misc")
def q_scalar_misc(spark, sf_dir):
    tb = Testbed(spark, sf_dir)
    c = tb.customer
    bal = F.col("c_acctbal")
    lo, hi = S.band(bal / F.lit(1000.0), F.lit(0.5))
    return c.select(
        "c_custkey",
        F.round(bal / F.lit(365.242), 4).alias("r4"),
        F.round(bal.cast("decimal(38,9)"), 4).cast("double").alias("num4"),
        S.topcode(bal / F.lit(100.0), 89, 91.4).alias("topcoded"),
        S.capitalise(F.col("c_mktsegment")).alias("cap"),
        F.lower(F.col("c_name")).like("%1%").alias("name_has_1"),
        S.binary_recode("c_mktsegment", "BUILDING", "Yes", "No").alias("is_building"),
        S.reversed_hour_index(bal / F.lit(250.0), 45).alias("rev_hour"),
        F.round(S.sigmoid(bal / F.lit(1000.0)), 9).alias("sig"),
        S.threshold_label(S.sigmoid(bal / F.lit(1000.0))).alias("pos"),
        F.round(lo, 9).alias("band_lo"), F.round(hi, 9).alias("band_hi"),
        S.safe_divide(bal, F.col("c_nationkey")).alias("per_nation"))


__all__ = ["QUERIES"]


# ---------------------------------------------------------------------------
# training (rows-only checks: statistical, not bit-equal)
from wardline.operators import boosting as B  # noqa: E402
from wardline.operators import train as M  # noqa: E402

MODEL_FEATURES = ["admission_age", "gender"] + X.recode_vocab(SEGMENT_KEYWORDS, SEGMENT_DEFAULT)
FOLDS = 5
TRIALS, ROUNDS, PATIENCE = 50, 1000, 100


def training_frames(tb: Testbed):
    mf = materialize(model_frame(tb))
    mf = X.stratified_split(mf, "icustay_id", "label", 0.1, seed=SEED)
    stats = X.minmax_fit(mf.where(F.col("is_test") == 0), MODEL_FEATURES)
    mf = materialize(X.minmax_apply(mf, stats, MODEL_FEATURES))
    return mf.where(F.col("is_test") == 0), mf.where(F.col("is_test") == 1)


def measured_frames(tb: Testbed):
    """Train and test rows of the stacked frame (a plain 25 % test split, seed 0): encoded, imputed with the medians
    of all rows (a measure without any value is 0) and scaled over all rows, before the split."""
    features = MODEL_FEATURES + MEASURE_FEATS
    mf = X.one_hot(materialize(stacked_frame(tb)), "ethnicity", X.recode_vocab(SEGMENT_KEYWORDS, SEGMENT_DEFAULT))
    mf = A.impute_median(X.label_encode(mf, "gender"), MEASURE_FEATS).na.fill(0.0, MEASURE_FEATS)
    mf = X.minmax_apply(mf, X.minmax_fit(mf, features), features)
    mf = materialize(X.random_split(mf, "icustay_id", 0.25, seed=0))
    return mf.where(F.col("is_test") == 0), mf.where(F.col("is_test") == 1), features


@query("train_lr")
def q_train_lr(spark, sf_dir):
    train, test, features = measured_frames(Testbed(spark, sf_dir))
    model = M.train_lr(train, features)
    return M.predict(model, test).select("icustay_id", "label", "p")


@query("train_svm")
def q_train_svm(spark, sf_dir):
    train, test, features = measured_frames(Testbed(spark, sf_dir))
    pairs = M.train_svm_calibrated(train, features, id_col="icustay_id", folds=FOLDS, seed=SEED)
    return M.predict_svm_calibrated(pairs, test, features).select("icustay_id", "label", "p")


def _search(tb: Testbed):
    """Binned training frame, the results of all trials, and the test rows."""
    def build():
        train, test = training_frames(tb)
        frame = B.binned_frame(train, MODEL_FEATURES, id_col="icustay_id", folds=FOLDS, seed=SEED)
        results = B.search(tb.spark, frame, B.sample_space(TRIALS, SEED), folds=FOLDS, rounds=ROUNDS, patience=PATIENCE, seed=SEED)
        return frame, materialize(results), test
    return tb.memo("search", build)


def _best(tb: Testbed):
    """The best trial, its fold models as a table of nodes, and their predictions of the test rows."""
    def build():
        frame, results, test = _search(tb)
        best = B.best_trial(results)
        nodes = materialize(B.fit_folds(tb.spark, frame, best, folds=FOLDS, rounds=best["rounds"], seed=SEED))
        return best, nodes, B.predict_folds(test, nodes, frame, "icustay_id")
    return tb.memo("best", build)


@query("tune")
def q_tune(spark, sf_dir):
    """Every trial with its score, the mean held-out AUC over all rounds up to the best."""
    _, results, _ = _search(Testbed(spark, sf_dir))
    return results.drop("aucs")


@query("train_gbt")
def q_train_gbt(spark, sf_dir):
    """Mean probability of the best trial's fold models on the test rows."""
    return _best(Testbed(spark, sf_dir))[2].select("icustay_id", "label", "p")


def _fold_curve(tb: Testbed) -> DataFrame:
    _, results, _ = _search(tb)
    return B.fold_curve(tb.spark, B.best_trial(results)["aucs"])


@query("gbt_cv_curve")
def q_gbt_cv_curve(spark, sf_dir):
    """Per boosting round, mean / sd / 95 % band of the held-out AUC over the folds of the best trial."""
    return V.cv_band(_fold_curve(Testbed(spark, sf_dir)), "round", "auc")


@query("gbt_fold_metrics")
def q_gbt_fold_metrics(spark, sf_dir):
    """Band of the held-out AUC at the best round."""
    curve = _fold_curve(Testbed(spark, sf_dir))
    return V.cv_band(curve.where(F.col("round") == curve.agg(F.max("round")).first()[0]), "round", "auc")


@query("top_importance")
def q_top_importance(spark, sf_dir):
    """The ten features that split most often, from the saved node tables."""
    _, nodes, _ = _best(Testbed(spark, sf_dir))
    return V.top_k(B.importances(nodes, MODEL_FEATURES, FOLDS), "splits", 10, ["feature"])


# ---------------------------------------------------------------------------
@query("window_join_96h")
def q_window_join_96h(spark, sf_dir):
    from wardline.operators.joins import window_join
    tb = Testbed(spark, sf_dir)
    anchors = materialize(tb.suspicion.select("icustay_id", "suspected_infection_time").join(
        tb.icustays.select("icustay_id", "subject_id", "hadm_id"), "icustay_id"))
    ev = tb.labevents.select("subject_id", "hadm_id", "charttime", "itemid", "valuenum")
    return window_join(anchors, ev, ["subject_id", "hadm_id"], "suspected_infection_time",
                       "charttime", 96, how="left")


@query("split_sequences")
def q_split_sequences(spark, sf_dir):
    """C14: stays split (stratified by label) and their hourly rows routed to train / test."""
    tb = Testbed(spark, sf_dir)
    seq = materialize(rounded(sequence_frame(tb), LAB_COLS + VIT_COLS))
    stays = seq.select("icustay_id", "label").distinct()
    split = X.stratified_split(stays, "icustay_id", "label", 0.1, seed=SEED).select("icustay_id", "is_test")
    return seq.join(split, "icustay_id")


@query("roc_curve_auc")
def q_roc_curve_auc(spark, sf_dir):
    """Trapezoid area of the stored ROC points (equals the exact AUC)."""
    pts = V.roc_curve(Testbed(spark, sf_dir).scored, "y", "p")
    pts = pts.withColumn("_ord", F.col("fpr") * F.lit(2.0) + F.col("tpr"))
    return rounded(V.curve_auc(pts, "_ord", "fpr", "tpr").withColumnRenamed("auc", "roc_auc"), ["roc_auc"], 9)


@query("model_metrics")
def q_model_metrics(spark, sf_dir):
    """J7-J11 on model output: metrics of the fold-ensemble predictions on the test split."""
    return V.classification_metrics(materialize(_best(Testbed(spark, sf_dir))[2]), "label", "p")


# ---------------------------------------------------------------------------
# p-values, per-fold scaling, ranks, sequences by cell, sparse columns
def _train_sequences(tb: Testbed) -> DataFrame:
    """Sequence rows of the training stays with the fold of their stay."""
    seq = materialize(rounded(sequence_frame(tb), LAB_COLS + VIT_COLS))
    stays = X.stratified_split(seq.select("icustay_id", "label").distinct(), "icustay_id", "label", 0.1, seed=SEED)
    folds = X.stratified_folds(stays.where(F.col("is_test") == 0), "icustay_id", "label", FOLDS, seed=SEED)
    return seq.join(folds.select("icustay_id", "fold"), "icustay_id")


@query("fold_scaled_sequences")
def q_fold_scaled_sequences(spark, sf_dir):
    """The training sequences once per fold model, scaled with the rows of the other folds."""
    rows = materialize(_train_sequences(Testbed(spark, sf_dir)))
    cols = ["hr", *LAB_COLS, *VIT_COLS]
    out = X.fold_scale(rows.withColumn("hour", F.col("hr")), cols, FOLDS)
    return rounded(out.select("model", "is_valid", "icustay_id", "hour", "label", *cols), cols)


@query("average_rank")
def q_average_rank(spark, sf_dir):
    """M2: average rank of every order's total price within its priority."""
    o = Testbed(spark, sf_dir).table("orders").select("o_orderkey", "o_orderpriority", F.floor(F.col("o_totalprice") / 1000).alias("price"))
    return avg_rank(o, "price", group=["o_orderpriority"])


@query("sequence_cells")
def q_sequence_cells(spark, sf_dir):
    """X6, a row per cell of the assembled matrices."""
    seqs = q_sequences(spark, sf_dir)
    return _cells(seqs.select("icustay_id", "length", F.posexplode("seq").alias("step", "row")), ["icustay_id", "length", "step"])


@query("padded_cells")
def q_padded_cells(spark, sf_dir):
    """X7, a row per cell of the padded matrices."""
    seqs = q_padded_sequences(spark, sf_dir)
    keys = ["icustay_id", "batch", "pos", "length"]
    return _cells(seqs.select(*keys, F.posexplode("padded").alias("step", "row")), [*keys, "step"])


def _cells(rows: DataFrame, keys) -> DataFrame:
    return rows.select(*keys, F.posexplode("row").alias("feature", "value"))


@query("kept_columns")
def q_kept_columns(spark, sf_dir):
    """Every measure column with its share of values, and whether ``drop_sparse`` keeps it."""
    w = materialize(stacked_measures(Testbed(spark, sf_dir)))
    kept = [c for c in X.drop_sparse(w, MEASURE_FEATS, 0.5).columns if c in MEASURE_FEATS]
    fractions = w.agg(*[(F.count(c) / F.count(F.lit(1))).alias(c) for c in MEASURE_FEATS])
    long = fractions.select(F.explode(F.array(*[F.struct(F.lit(c).alias("measure"), F.round(c, 6).alias("fraction"))
                                                for c in MEASURE_FEATS])).alias("e")).select("e.*")
    return long.withColumn("kept", F.col("measure").isin(kept))


# ---------------------------------------------------------------------------
# sources and sinks
MATCHED_SCHEMA = ("icustay_id long, hadm_id long, intime timestamp_ntz, outtime timestamp_ntz, length_of_stay double, "
                  "subject_id long, control_onset_time timestamp_ntz, control_onset_hour double, matched_case_icustay_id long")


@query("matched_controls_table")
def q_matched_controls_table(spark, sf_dir):
    """Matched controls stored with their declared schema, the row count checked by the write, read back."""
    tb = Testbed(spark, sf_dir)
    schema = T_.StructType.fromDDL(MATCHED_SCHEMA)
    path = scratch_path(spark, "matched_controls")
    write_matched(cases_m(tb), controls_m(tb), path, schema, seed=SEED)
    out = spark.read.parquet(path)
    if out.schema != schema:
        raise ValueError(f"stored schema {out.schema.simpleString()}")
    return out


@query("bucketed_lab_stats")
def q_bucketed_lab_stats(spark, sf_dir):
    """The lab log stored in hash buckets of the admission; the join with admissions and
    the statistics per admission shuffle the log no more."""
    tb = Testbed(spark, sf_dir)
    labs = save_bucketed(tb.labevents.where(F.col("valuenum").isNotNull()), "labevents", ["hadm_id"], LOG_BUCKETS)
    adm = materialize(tb.admissions.select("hadm_id", "admittime"))
    rows = labs.join(adm, "hadm_id").where(F.col("charttime") >= F.col("admittime"))
    out = A.group_stats(rows, "hadm_id", "valuenum", "lab")
    return rounded(out, ["lab_avg", "lab_stddev"])


LOG_BUCKETS = 16


@query("derived_tables")
def q_derived_tables(spark, sf_dir):
    """A2, A4: derived tables stored by name and passed through as they are, each row with its table."""
    tb = Testbed(spark, sf_dir)
    parts = []
    for name, df in (("suspicion", tb.suspicion.select("icustay_id", F.col("suspected_infection_time").alias("at"))),
                     ("scores", tb.scores.select("icustay_id", F.col("endtime").alias("at")))):
        table = f"{name}_{uuid.uuid4().hex[:12]}"
        save(df, table, path=scratch_path(spark, name))
        parts.append(load_table(spark, table).withColumn("source_table", F.lit(name)))
    return concat(parts)


@query("curve_csv")
def q_curve_csv(spark, sf_dir):
    """ROC points written as CSV with a header and read back with a schema."""
    path = scratch_path(spark, "roc")
    save_csv(V.roc_curve(Testbed(spark, sf_dir).scored, "y", "p").select("fpr", "tpr"), path)
    return rounded(load_csv(spark, path, "fpr double, tpr double"), ["fpr", "tpr"], 9)


# ---------------------------------------------------------------------------
# the clinical item tables (``specs``) on logs that bear their item ids
def clinical_labs(tb: Testbed) -> DataFrame:
    return tb.clinical(tb.labevents, [i for i, _ in specs.LAB_LABELS] + specs.LAB_UNLABELLED)


@query("clinical_lab_series")
def q_clinical_lab_series(spark, sf_dir):
    """B6, B7, G5 with all 47 labelled items: 40 columns in the 48 h before onset."""
    tb = Testbed(spark, sf_dir)
    return measure_series(series_anchors(tb, cases_m(tb), "sepsis_onset"), clinical_labs(tb), specs.lab_series_spec(),
                          keys=["subject_id", "hadm_id"], anchor_col="sepsis_onset", time_col="charttime", hours=48)


@query("clinical_vital_series")
def q_clinical_vital_series(spark, sf_dir):
    """B8, B9, G6 with the ordered range rules of all charted items: 23 columns in the 48 h before onset."""
    tb = Testbed(spark, sf_dir)
    charts = tb.clinical(tb.chartevents, specs.VITAL_ITEMS)
    out = measure_series(series_anchors(tb, cases_m(tb), "sepsis_onset"), charts, specs.vital_series_spec(), keys="icustay_id",
                         anchor_col="sepsis_onset", time_col="charttime", hours=48, event_filter=F.col("error") == 0)
    return rounded(out, ["TempC"], 9)


@query("clinical_lab_events")
def q_clinical_lab_events(spark, sf_dir):
    """B12, G8 with the 26 hourly items: long rows of the 48 h before the suspicion of infection."""
    tb = Testbed(spark, sf_dir)
    anchors = materialize(tb.suspicion.select("icustay_id", "suspected_infection_time").join(
        tb.icustays.select("icustay_id", "hadm_id"), "icustay_id"))
    labs = tb.clinical(tb.labevents, specs.HOURLY_LAB_ITEMS)
    return lab_events_before(anchors, labs, specs.hourly_lab_spec(), keys="hadm_id", anchor_col="suspected_infection_time",
                             time_col="charttime", hours=48)


@query("clinical_panels")
def q_clinical_panels(spark, sf_dir):
    """D2 with the nine clinical panels."""
    tb = Testbed(spark, sf_dir)
    out = A.panel_stats(tb.panel_events, tb.clinical_dictionary, specs.LAB_PANELS)
    return rounded(out, [f"{p[0]}_{s}" for p in specs.LAB_PANELS for s in ("avg", "stddev")])
