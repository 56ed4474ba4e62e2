"""Bind the driver's synthetic tables to the clinical schema.

The clinical tables are not available, so each role is *derived by Spark*
from the test tables (the work grows with them):

=================  ==========================================================
role               derived from
=================  ==========================================================
icustays           ``events`` grouped per user and 5-day period of the month
admissions         ``events`` grouped per user and 10-day period + ``customer``
patients           ``customer`` (gender from segment, dob from balance)
services           ``click`` events (service from value)
suspicion          first ``signup`` with value >= 60 per stay
scores             ``error`` events (score = floor(value / 10), 1 h rows)
diagnoses          ``orders`` (code = order priority, admission from month)
labevents          ``click`` / ``view`` events (item = 1000/2000 + props.k)
chartevents        ``purchase`` / ``view`` events (item = 3000/2000 + props.k)
=================  ==========================================================

The item specs for these synthetic items are built from rules below; the
clinical specs live in ``wardline.specs``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.sources.io import load
from wardline.specs import LabelSpec, RuleSpec

DIAGNOSIS_CODES = ["1-URGENT"]
SURGICAL = ["CSURG", "TSURG"]
SEGMENT_KEYWORDS = ["O", "BUILD", "AUTO", "HOUSE"]
SEGMENT_DEFAULT = "OTHER"
# dictionary labels that the clinical panels look for, and some that only resemble them
CLINICAL_ITEM_LABELS = ["WBC", "wbc, Ascites", "Creatinine", "Anion Gap", "Calculated Anion Gap", "Sodium, Whole Blood", "Hemoglobin", "Lactate",
                        "Lactate Dehydrogenase", "Potassium", "Urea Nitrogen", "Glucose, CSF", "Hematocrit", "Creatinine, Urine"]
# per-subject lab panels over the part dictionary: (name, test, pattern, filter column)
TEST_PANELS = [
    ("econ", "like", "econ", "valuenum"),
    ("promo", "like", "promo", "valuenum"),
    ("standard", "like", "standard", "valuenum"),
    ("ar", "like", "ar", "valuenum"),
    ("medium", "in", "MEDIUM", "value"),
]


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _period(days: int) -> Column:
    return F.floor((F.dayofmonth("ts") - F.lit(1)) / F.lit(days)).cast("long")


def _hadm() -> Column:
    return F.col("user_id") * F.lit(10) + _period(10)


def _icustay() -> Column:
    return F.col("user_id") * F.lit(100) + _period(5)


def _first(value: str, order: str) -> Column:
    return F.min(F.struct(F.col(order), F.col(value)))[value]


@dataclass
class Testbed:
    spark: SparkSession
    sf_dir: str

    def memo(self, key: str, build):
        """Build a derived frame once per binding (per query)."""
        store = self.__dict__.setdefault("_memo", {})
        if key not in store:
            store[key] = build()
        return store[key]

    def table(self, name: str) -> DataFrame:
        return load(self.spark, self.sf_dir, name)

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    @cached_property
    def customer(self) -> DataFrame:
        return self.table("customer")

    @cached_property
    def icustays(self) -> DataFrame:
        e = self.events.select(_icustay().alias("icustay_id"), F.col("user_id").alias("subject_id"),
                               _hadm().alias("hadm_id"), "ts", "event_type")
        stays = e.groupBy("icustay_id", "subject_id", "hadm_id").agg(
            F.min("ts").alias("intime"), F.max("ts").alias("outtime"),
            _first("event_type", "ts").alias("first_careunit"))
        cust = self.customer.select(
            F.col("c_custkey").alias("subject_id"),
            F.when(F.col("c_nationkey") < 5, "carevue").otherwise("metavision").alias("dbsource"))
        return stays.join(cust, "subject_id", "left").select(
            "subject_id", "hadm_id", "icustay_id", "intime", "outtime", "dbsource", "first_careunit")

    @cached_property
    def admissions(self) -> DataFrame:
        e = self.events.select(_hadm().alias("hadm_id"), F.col("user_id").alias("subject_id"),
                               "ts", "event_type")
        adm = e.groupBy("hadm_id", "subject_id").agg(
            F.min("ts").alias("admittime"), F.max("ts").alias("dischtime"),
            _first("event_type", "ts").alias("admission_type"),
            F.max("event_type").alias("admission_location"),
            _first("event_type", "ts").alias("marital_status"),
            F.when(F.count(F.lit(1)) > 20, "Medicare").otherwise("Private").alias("insurance"))
        cust = self.customer.select(
            F.col("c_custkey").alias("subject_id"), F.col("c_mktsegment").alias("ethnicity"),
            F.when(F.col("c_acctbal") < 0, 0).otherwise(1).alias("has_chartevents_data"))
        return adm.join(cust, "subject_id", "left")

    @cached_property
    def patients(self) -> DataFrame:
        c = self.customer
        days = F.floor((F.col("c_acctbal") + F.lit(1000.0)) * F.lit(3.65)).cast("int")
        base = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
        return c.select(
            F.col("c_custkey").alias("subject_id"),
            F.when(F.col("c_mktsegment").isin("AUTOMOBILE", "HOUSEHOLD"), "F").otherwise("M").alias("gender"),
            (base - F.make_dt_interval(days)).alias("dob"),
            F.when(F.col("c_acctbal") > 8000, F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
             .alias("dod"))

    @cached_property
    def services(self) -> DataFrame:
        v = F.col("value")
        return self.events.where(F.col("event_type") == "click").select(
            _hadm().alias("hadm_id"), F.col("ts").alias("transfertime"),
            F.when(v < 20, "CSURG").when(v < 40, "TSURG").otherwise("MED").alias("curr_service"))

    @cached_property
    def suspicion(self) -> DataFrame:
        s = (self.events.where((F.col("event_type") == "signup") & (F.col("value") >= 60))
             .select(_icustay().alias("icustay_id"), "ts", "value")
             .groupBy("icustay_id").agg(
                 F.min("ts").alias("suspected_infection_time"), F.lit("BLOOD").alias("specimen"),
                 F.max(F.when(F.col("value") >= 200, 1).otherwise(0)).alias("positiveculture"),
                 F.max("ts").alias("antibiotic_time")))
        return self.icustays.select("icustay_id").join(s, "icustay_id", "left")

    @cached_property
    def scores(self) -> DataFrame:
        return self.events.where(F.col("event_type") == "error").select(
            _icustay().alias("icustay_id"), F.col("ts").alias("starttime"),
            (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(1))).alias("endtime"),
            F.floor(F.col("value") / F.lit(10.0)).cast("int").alias("sofa_24hours"))

    @cached_property
    def diagnoses(self) -> DataFrame:
        o = self.table("orders")
        month_period = F.floor((F.month("o_orderdate") - F.lit(1)) / F.lit(4)).cast("long")
        return o.select(F.col("o_custkey").alias("subject_id"),
                        (F.col("o_custkey") * F.lit(10) + month_period).alias("hadm_id"),
                        F.col("o_orderpriority").alias("icd9_code"))

    @cached_property
    def labevents(self) -> DataFrame:
        e = self.events.where(F.col("event_type").isin("click", "view"))
        base = F.when(F.col("event_type") == "click", 1000).otherwise(2000)
        return e.select(F.col("user_id").alias("subject_id"), _hadm().alias("hadm_id"),
                        (base + _k()).cast("long").alias("itemid"), F.col("ts").alias("charttime"),
                        F.col("value").alias("valuenum"))

    @cached_property
    def chartevents(self) -> DataFrame:
        e = self.events.where(F.col("event_type").isin("purchase", "view"))
        base = F.when(F.col("event_type") == "purchase", 3000).otherwise(2000)
        return e.select(_icustay().alias("icustay_id"), (base + _k()).cast("long").alias("itemid"),
                        F.col("ts").alias("charttime"), F.col("value").alias("valuenum"),
                        F.when(F.col("value") >= 300, 1).otherwise(0).alias("error"))


    def clinical(self, log: DataFrame, items: list[int]) -> DataFrame:
        """The log with the clinical item ids ``items`` in place of the synthetic ones, by position."""
        ids = F.array(*[F.lit(i).cast("long") for i in items])
        return log.withColumn("itemid", F.element_at(ids, (F.col("itemid") % len(items) + 1).cast("int")))

    @cached_property
    def clinical_dictionary(self) -> DataFrame:
        """Parts as lab items, with one of the ``CLINICAL_ITEM_LABELS`` each."""
        names = F.array(*[F.lit(x) for x in CLINICAL_ITEM_LABELS])
        return self.table("part").select(F.col("p_partkey").alias("itemid"), F.element_at(
            names, (F.col("p_partkey") % len(CLINICAL_ITEM_LABELS) + 1).cast("int")).alias("label"))

    @cached_property
    def panel_events(self) -> DataFrame:
        """Long lab log for per-subject panels: ``lineitem`` (subject = supplier,
        item = part, numeric value = quantity unless no discount, text value =
        return flag unless no tax)."""
        li = self.table("lineitem")
        return li.select(
            F.col("l_suppkey").alias("subject_id"), F.col("l_partkey").alias("itemid"),
            F.when(F.col("l_discount") == 0, F.lit(None)).otherwise(F.col("l_quantity")).alias("valuenum"),
            F.when(F.col("l_tax") == 0, F.lit(None)).otherwise(F.col("l_returnflag")).alias("value"))

    @cached_property
    def lab_dictionary(self) -> DataFrame:
        return self.table("part").select(F.col("p_partkey").alias("itemid"), F.col("p_type").alias("label"))

    @cached_property
    def scored(self) -> DataFrame:
        """Binary outcome with a probability-like score: ``labels.quality`` and
        ``n / (n + 2000)`` of the document length (ties kept)."""
        d = self.table("documents").select("doc_id", "n_chars")
        return self.table("labels").join(d, "doc_id").select(
            "doc_id", F.col("quality").alias("y"),
            (F.col("n_chars").cast("double") / (F.col("n_chars") + F.lit(2000.0))).alias("p"))


# ---------------------------------------------------------------------------
# Item specs for the synthetic items, built from rules.
def lab_spec() -> LabelSpec:
    labels = [(1000 + k, f"C{k // 10}") for k in range(50)] + [(2000 + k, f"V{k // 10}") for k in range(30)]
    bounds = [(1000 + k, 1.0 if k < 10 else None, 100.0 + 50.0 * (k // 10)) for k in range(50)]
    bounds += [(2000 + k, None, 250.0) for k in range(30)]
    cols = [f"C{i}" for i in range(5)] + [f"V{i}" for i in range(3)]
    return LabelSpec(labels, bounds, cols, [1090 + k for k in range(5)])


def vital_spec() -> RuleSpec:
    def r(a, b):
        return tuple(range(a, b + 1))
    rules = [
        (r(3000, 3009), 70, False, 120, False, 6),
        (r(2040, 2049), 10, False, 50, False, 6),
        (r(3010, 3029), 0, False, 300, False, 1),
        (r(2000, 2019), 0, False, 100, True, 7),
        (r(2020, 2029), None, False, None, False, 13),
        (r(3030, 3049), 0, True, None, False, 24),
        (r(3050, 3059), 0, False, None, False, 8),
    ]
    items = [i for rule in rules for i in rule[0]]
    cols = [(1, "HeartRate"), (7, "SpO2"), (6, "TempC"), (13, "SVV"), (24, "FiO2")]
    return RuleSpec(rules, items, cols, list(r(3000, 3009)))
