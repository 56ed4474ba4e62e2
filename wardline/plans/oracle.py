"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written directly in SQL against the driver's pre-registered views; it shares
no code with the Spark operators, only the bindings documented in
``wardline.plans.testbed``.  ``sql(name)`` returns one statement whose WITH
clause carries the derived tables it needs.
"""

from __future__ import annotations

from wardline import specs
from wardline.plans.testbed import CLINICAL_ITEM_LABELS

CTE: dict[str, str] = {}
DEPS: dict[str, list[str]] = {}


def _cte(name: str, body: str, deps: list[str] | None = None) -> None:
    CTE[name] = body.strip()
    DEPS[name] = deps or []


# ---------------------------------------------------------------------------
# bindings
_cte("ev", """
SELECT *, user_id * 10 + (day(ts) - 1) // 10 AS hadm_id,
       user_id * 100 + (day(ts) - 1) // 5 AS icustay_id,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
FROM events""")

_cte("icustays", """
SELECT s.subject_id, s.hadm_id, s.icustay_id, s.intime, s.outtime, c.dbsource, s.first_careunit
FROM (SELECT icustay_id, user_id AS subject_id, hadm_id, min(ts) AS intime, max(ts) AS outtime,
             min({'t': ts, 'e': event_type}).e AS first_careunit
      FROM ev GROUP BY icustay_id, user_id, hadm_id) s
LEFT JOIN (SELECT c_custkey AS subject_id,
                  CASE WHEN c_nationkey < 5 THEN 'carevue' ELSE 'metavision' END AS dbsource
           FROM customer) c ON s.subject_id = c.subject_id""", ["ev"])

_cte("admissions", """
SELECT a.hadm_id, a.subject_id, a.admittime, a.dischtime, a.admission_type, a.admission_location,
       a.marital_status, a.insurance, c.ethnicity, c.has_chartevents_data
FROM (SELECT hadm_id, user_id AS subject_id, min(ts) AS admittime, max(ts) AS dischtime,
             min({'t': ts, 'e': event_type}).e AS admission_type,
             max(event_type) AS admission_location,
             min({'t': ts, 'e': event_type}).e AS marital_status,
             CASE WHEN count(*) > 20 THEN 'Medicare' ELSE 'Private' END AS insurance
      FROM ev GROUP BY hadm_id, user_id) a
LEFT JOIN (SELECT c_custkey AS subject_id, c_mktsegment AS ethnicity,
                  CASE WHEN c_acctbal < 0 THEN 0 ELSE 1 END AS has_chartevents_data
           FROM customer) c ON a.subject_id = c.subject_id""", ["ev"])

_cte("patients", """
SELECT c_custkey AS subject_id,
       CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'HOUSEHOLD') THEN 'F' ELSE 'M' END AS gender,
       TIMESTAMP '2024-01-01 00:00:00' - to_days(CAST(floor((c_acctbal + 1000.0) * 3.65) AS INTEGER)) AS dob,
       CASE WHEN c_acctbal > 8000 THEN TIMESTAMP '2024-02-01 00:00:00' END AS dod
FROM customer""")

_cte("services", """
SELECT hadm_id, ts AS transfertime,
       CASE WHEN value < 20 THEN 'CSURG' WHEN value < 40 THEN 'TSURG' ELSE 'MED' END AS curr_service
FROM ev WHERE event_type = 'click'""", ["ev"])

_cte("suspicion", """
SELECT i.icustay_id, s.suspected_infection_time, s.specimen, s.positiveculture, s.antibiotic_time
FROM icustays i
LEFT JOIN (SELECT icustay_id, min(ts) AS suspected_infection_time, 'BLOOD' AS specimen,
                  max(CASE WHEN value >= 200 THEN 1 ELSE 0 END) AS positiveculture,
                  max(ts) AS antibiotic_time
           FROM ev WHERE event_type = 'signup' AND value >= 60 GROUP BY icustay_id) s
  ON i.icustay_id = s.icustay_id""", ["icustays", "ev"])

_cte("scores", """
SELECT icustay_id, ts AS starttime, ts + INTERVAL 1 HOUR AS endtime,
       CAST(floor(value / 10.0) AS INTEGER) AS sofa_24hours
FROM ev WHERE event_type = 'error'""", ["ev"])

_cte("diagnoses", """
SELECT o_custkey AS subject_id, o_custkey * 10 + (month(o_orderdate) - 1) // 4 AS hadm_id,
       o_orderpriority AS icd9_code
FROM orders""")

_cte("labevents", """
SELECT user_id AS subject_id, hadm_id,
       CAST(CASE WHEN event_type = 'click' THEN 1000 ELSE 2000 END + k AS BIGINT) AS itemid,
       ts AS charttime, value AS valuenum
FROM ev WHERE event_type IN ('click', 'view')""", ["ev"])

_cte("chartevents", """
SELECT icustay_id, CAST(CASE WHEN event_type = 'purchase' THEN 3000 ELSE 2000 END + k AS BIGINT) AS itemid,
       ts AS charttime, value AS valuenum, CASE WHEN value >= 300 THEN 1 ELSE 0 END AS error
FROM ev WHERE event_type IN ('purchase', 'view')""", ["ev"])

# ---------------------------------------------------------------------------
# cohort
_cte("opening_service", """
SELECT hadm_id, min({'t': transfertime, 's': curr_service}).s AS first_service FROM services GROUP BY hadm_id""",
     ["services"])

_cte("aged_stay", """
SELECT i.icustay_id, hadm_id, subject_id, i.intime, i.outtime, i.dbsource, a.ethnicity, p.gender,
       a.has_chartevents_data = 0 AS no_chart, round(date_diff('day', p.dob, a.admittime) / 365.242, 4) AS years
FROM icustays i
JOIN (SELECT hadm_id, admittime, ethnicity, has_chartevents_data FROM admissions) a USING (hadm_id)
JOIN (SELECT subject_id, dob, gender FROM patients) p USING (subject_id)""", ["icustays", "admissions", "patients"])

_cte("earliest_stay", """
SELECT min({'t': intime, 'id': icustay_id}).id AS icustay_id FROM aged_stay GROUP BY subject_id""", ["aged_stay"])

_cte("suspected", """
SELECT icustay_id, suspected_infection_time AS susp_time, specimen, positiveculture, antibiotic_time
FROM suspicion WHERE suspected_infection_time IS NOT NULL""", ["suspicion"])


def _flag(cond: str) -> str:
    """0/1 of a condition, unknown counting as 0."""
    return f"coalesce(CAST(({cond}) AS INTEGER), 0)"


_FLAGS = {
    "exclusion_secondarystay": "icustay_id NOT IN (SELECT icustay_id FROM earliest_stay)",
    "exclusion_nonadult": "years <= 14",
    "exclusion_csurg": "first_service IN ('CSURG', 'TSURG')",
    "exclusion_carevue": "dbsource <> 'metavision'",
    "exclusion_early_suspicion": "susp_time + INTERVAL 1 DAY < intime",
    "exclusion_late_suspicion": "susp_time - INTERVAL 1 DAY > intime",
    "exclusion_suspicion_before_4_hours": "susp_time - INTERVAL 4 HOUR < intime",
    "exclusion_bad_data": "no_chart OR intime IS NULL OR outtime IS NULL",
}
_ANY = ("exclusion_nonadult", "exclusion_carevue", "exclusion_suspicion_before_4_hours", "exclusion_bad_data")
_cte("cohort", f"""
SELECT *, greatest({", ".join(_ANY)}) AS excluded
FROM (SELECT hadm_id, icustay_id, intime, outtime, if(years > 89, 91.4::DOUBLE, years) AS age, gender, ethnicity,
             first_service, dbsource, CAST(susp_time IS NOT NULL AS INTEGER) AS suspected_of_infection_poe,
             susp_time AS suspected_infection_time_poe,
             CAST(date_diff('second', susp_time, intime) AS DOUBLE) / 86400.0 AS suspected_infection_time_poe_days,
             specimen AS specimen_poe, positiveculture AS positiveculture_poe, antibiotic_time AS antibiotic_time_poe,
             {", ".join(f"{_flag(c)} AS {n}" for n, c in _FLAGS.items())}
      FROM aged_stay LEFT JOIN opening_service USING (hadm_id) LEFT JOIN suspected USING (icustay_id))""",
     ["aged_stay", "opening_service", "suspected", "earliest_stay"])

_cte("onset", """
SELECT icustay_id, susp_time AS suspected_infection_time, best.t AS sepsis_onset, best.s AS sofa_24hours,
       CAST(1 AS BIGINT) AS row_id
FROM (SELECT icustay_id, susp_time, min({'t': endtime, 's': sofa_24hours}) AS best
      FROM (SELECT * FROM scores WHERE sofa_24hours >= 2) JOIN suspected USING (icustay_id)
      WHERE date_diff('hour', susp_time, starttime) BETWEEN -48 AND 24
      GROUP BY icustay_id, susp_time)""", ["scores", "suspected"])

# stays with clean data: what both arms ask for
_cte("usable_stay", """
SELECT c.icustay_id, c.hadm_id, c.intime, c.outtime, s.subject_id, c.suspected_of_infection_poe,
       CAST(date_diff('second', c.intime, c.outtime) AS DOUBLE) / 3600.0 AS length_of_stay
FROM (SELECT * FROM cohort WHERE age > 16 AND dbsource = 'metavision' AND intime IS NOT NULL AND outtime IS NOT NULL) c
JOIN (SELECT icustay_id, subject_id FROM icustays) s USING (icustay_id)
WHERE c.hadm_id IN (SELECT hadm_id FROM admissions WHERE has_chartevents_data <> 0)""",
     ["cohort", "icustays", "admissions"])

_cte("cases", """
SELECT icustay_id, intime, outtime, length_of_stay, sepsis_onset, seconds / 86400.0 AS sepsis_onset_day,
       seconds / 3600.0 AS sepsis_onset_hour, subject_id
FROM (SELECT *, CAST(date_diff('second', intime, sepsis_onset) AS DOUBLE) AS seconds
      FROM usable_stay JOIN (SELECT icustay_id, sepsis_onset FROM onset) USING (icustay_id)
      WHERE suspected_of_infection_poe = 1 AND sepsis_onset BETWEEN intime AND outtime)""", ["usable_stay", "onset"])

_cte("controls", """
SELECT icustay_id, hadm_id, intime, outtime, length_of_stay, CAST(NULL AS TIMESTAMP) AS sepsis_onset, subject_id
FROM usable_stay
WHERE hadm_id NOT IN (SELECT hadm_id FROM diagnoses WHERE icd9_code = '1-URGENT')
  AND icustay_id NOT IN (SELECT icustay_id FROM onset)""", ["usable_stay", "onset", "diagnoses"])

# ---------------------------------------------------------------------------
# measurement specs of the synthetic items (see testbed.lab_spec / vital_spec)
LAB_ITEMS = "(itemid BETWEEN 1000 AND 1049 OR itemid BETWEEN 2000 AND 2029)"
LAB_LABEL = ("CASE WHEN itemid BETWEEN 1000 AND 1049 THEN 'C' || CAST((itemid - 1000) // 10 AS VARCHAR) "
             "WHEN itemid BETWEEN 2000 AND 2029 THEN 'V' || CAST((itemid - 2000) // 10 AS VARCHAR) END")
LAB_VALUE = ("CASE WHEN itemid BETWEEN 1000 AND 1009 AND valuenum < 1.0 THEN NULL "
             "WHEN itemid BETWEEN 1000 AND 1049 AND valuenum > 100.0 + 50.0 * ((itemid - 1000) // 10) THEN NULL "
             "WHEN itemid BETWEEN 2000 AND 2029 AND valuenum > 250.0 THEN NULL ELSE valuenum END")
LAB_COLS = ["C0", "C1", "C2", "C3", "C4", "V0", "V1", "V2"]
VIT_ITEMS = "(itemid BETWEEN 3000 AND 3049 OR itemid BETWEEN 2000 AND 2029 OR itemid BETWEEN 2040 AND 2049)"
VIT_ID = """CASE
  WHEN itemid BETWEEN 3000 AND 3009 AND valuenum > 70 AND valuenum < 120 THEN 6
  WHEN itemid BETWEEN 2040 AND 2049 AND valuenum > 10 AND valuenum < 50 THEN 6
  WHEN itemid BETWEEN 3010 AND 3029 AND valuenum > 0 AND valuenum < 300 THEN 1
  WHEN itemid BETWEEN 2000 AND 2019 AND valuenum > 0 AND valuenum <= 100 THEN 7
  WHEN itemid BETWEEN 2020 AND 2029 THEN 13
  WHEN itemid BETWEEN 3030 AND 3049 AND valuenum >= 0 THEN 24
  WHEN itemid BETWEEN 3050 AND 3059 AND valuenum > 0 THEN 8
END"""
VIT_VALUE = "CASE WHEN itemid BETWEEN 3000 AND 3009 THEN (valuenum - 32) / 1.8 ELSE valuenum END"
VIT_COLS = [(1, "HeartRate"), (7, "SpO2"), (6, "TempC"), (13, "SVV"), (24, "FiO2")]


def _series_sql(anchor_table: str, anchor_col: str, hours: int, join: str, measured: str, on: str,
                cols: dict[str, str]) -> str:
    """One wide row per measurement in the hours up to each stay's anchor time."""
    values = ", ".join(f"CAST(if(m.kind = {kind}, m.amount, NULL) AS DOUBLE) AS {name}" for name, kind in cols.items())
    return f"""
SELECT w.icustay_id, w.subject_id, m.taken AS chart_time, {values}
FROM (SELECT {anchor_table}.icustay_id, i.subject_id, i.hadm_id, {anchor_col} AS until,
             {anchor_col} - INTERVAL {hours} HOUR AS since
      FROM {anchor_table} LEFT JOIN icustays i USING (icustay_id)) w
{join} ({measured}) m ON {on} AND m.taken >= w.since AND m.taken <= w.until"""


def lab_series_sql(anchor_table: str, anchor_col: str, hours: int) -> str:
    measured = (f"SELECT subject_id, hadm_id, charttime AS taken, {LAB_LABEL} AS kind, {LAB_VALUE} AS amount "
                f"FROM labevents WHERE {LAB_ITEMS} AND valuenum > 0")
    return _series_sql(anchor_table, anchor_col, hours, "LEFT JOIN", measured,
                       "m.hadm_id = w.hadm_id AND m.subject_id = w.subject_id", {c: f"'{c}'" for c in LAB_COLS})


def vital_series_sql(anchor_table: str, anchor_col: str, hours: int) -> str:
    measured = (f"SELECT icustay_id, charttime AS taken, {VIT_ID} AS kind, {VIT_VALUE} AS amount "
                f"FROM chartevents WHERE error = 0 AND {VIT_ITEMS}")
    return _series_sql(anchor_table, anchor_col, hours, "JOIN", measured, "m.icustay_id = w.icustay_id",
                       {n: str(i) for i, n in VIT_COLS})


# ---------------------------------------------------------------------------
BODIES: dict[str, tuple[str, list[str]]] = {}


def register(name: str, body: str, deps: list[str]) -> None:
    BODIES[name] = (body.strip(), deps)


def _closure(deps: list[str]) -> list[str]:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in DEPS[n]:
            visit(d)
        order.append(n)

    for d in deps:
        visit(d)
    return order


def sql(name: str) -> str:
    body, deps = BODIES[name]
    names = _closure(deps)
    if not names:
        return body
    withs = ",\n".join(f"{n} AS (\n{CTE[n]}\n)" for n in names)
    if body.upper().startswith("WITH "):
        return f"WITH {withs},\n{body[5:]}"
    return f"WITH {withs}\n{body}"


register("base_cohort", "SELECT * FROM cohort", ["cohort"])
register("detect_onset", "SELECT * FROM onset", ["onset"])
register("build_cases", "SELECT * FROM cases", ["cases"])
register("build_controls", "SELECT * FROM controls", ["controls"])
register("lab_series_case_48h", lab_series_sql("cases", "sepsis_onset", 48), ["cases", "labevents", "icustays"])
register("lab_series_case_96h", lab_series_sql("cases", "sepsis_onset", 96), ["cases", "labevents", "icustays"])
register("vital_series_case_48h", vital_series_sql("cases", "sepsis_onset", 48), ["cases", "chartevents", "icustays"])
register("vital_series_case_96h", vital_series_sql("cases", "sepsis_onset", 96), ["cases", "chartevents", "icustays"])


def oracle_sql() -> dict[str, str]:
    return {name: sql(name) for name in BODIES}


# ---------------------------------------------------------------------------
# matching
_cte("matched", """
SELECT cj.icustay_id, cj.hadm_id, cj.intime, cj.outtime, cj.length_of_stay, cj.subject_id,
       cj.intime + to_microseconds(CAST(round(ci.sepsis_onset_hour * 3600000000.0) AS BIGINT))
         AS control_onset_time,
       ci.sepsis_onset_hour AS control_onset_hour,
       ci.icustay_id AS matched_case_icustay_id
FROM (SELECT *, row_number() OVER (ORDER BY md5('42|' || CAST(icustay_id AS VARCHAR)), icustay_id) - 1 AS j
      FROM (SELECT DISTINCT * FROM controls) d) cj
CROSS JOIN (SELECT (SELECT count(DISTINCT icustay_id) FROM cases) AS nc,
                   (SELECT count(DISTINCT icustay_id) FROM controls) AS nk) n
JOIN (SELECT icustay_id, sepsis_onset_hour, row_number() OVER (ORDER BY icustay_id) - 1 AS i FROM cases) ci
  ON ci.i = ((cj.j + 1) * n.nc + n.nk - 1) // n.nk - 1
WHERE ci.sepsis_onset_hour < cj.length_of_stay""", ["cases", "controls"])

register("match_controls", "SELECT * FROM matched", ["matched"])
register("match_ratio", """
SELECT (SELECT count(DISTINCT icustay_id) FROM cases) AS n_cases,
       (SELECT count(DISTINCT icustay_id) FROM controls) AS n_controls,
       CAST((SELECT count(DISTINCT icustay_id) FROM controls) AS DOUBLE)
         / (SELECT count(DISTINCT icustay_id) FROM cases) AS ratio,
       (SELECT count(*) FROM matched) AS n_matched""", ["cases", "controls", "matched"])
for _h in (48, 96):
    register(f"lab_series_control_{_h}h", lab_series_sql("matched", "control_onset_time", _h),
             ["matched", "labevents", "icustays"])
    register(f"vital_series_control_{_h}h", vital_series_sql("matched", "control_onset_time", _h),
             ["matched", "chartevents", "icustays"])



def _all_series_sql(series_sql) -> str:
    """Both arms and look-back lengths of a series, with their tags."""
    return "\nUNION ALL\n".join(
        f"SELECT {label} AS label, {h} AS horizon, a.{col} AS anchor_time, s.* FROM ({series_sql(arm, col, h)}) s JOIN {arm} a USING (icustay_id)"
        for label, arm, col in ((1, "cases", "sepsis_onset"), (0, "matched", "control_onset_time")) for h in (48, 96))


register("lab_series_all", _all_series_sql(lab_series_sql), ["cases", "matched", "labevents", "icustays"])
register("vital_series_all", _all_series_sql(vital_series_sql), ["cases", "matched", "chartevents", "icustays"])

register("lab_events_before", f"""
SELECT icustay_id, label, charttime, valuenum
FROM (
  SELECT a.icustay_id, le.charttime,
         CASE WHEN le.itemid BETWEEN 1000 AND 1019 THEN 'C' || CAST((le.itemid - 1000) // 10 AS VARCHAR) END AS label,
         {LAB_VALUE.replace('itemid', 'le.itemid').replace('valuenum', 'le.valuenum')} AS valuenum
  FROM (SELECT s.icustay_id, s.suspected_infection_time, ie.hadm_id
        FROM suspicion s JOIN icustays ie ON s.icustay_id = ie.icustay_id) a
  LEFT JOIN labevents le ON le.hadm_id = a.hadm_id
   AND le.charttime BETWEEN a.suspected_infection_time - INTERVAL 48 HOUR AND a.suspected_infection_time
   AND {LAB_ITEMS.replace('itemid', 'le.itemid')}
   AND le.valuenum IS NOT NULL AND le.valuenum > 0
) c
WHERE valuenum IS NOT NULL""", ["suspicion", "icustays", "labevents"])

register("window_join_48h", """
SELECT a.icustay_id, a.suspected_infection_time, a.subject_id, a.hadm_id,
       le.charttime, le.itemid, le.valuenum
FROM (SELECT s.icustay_id, s.suspected_infection_time, ie.subject_id, ie.hadm_id
      FROM suspicion s JOIN icustays ie ON s.icustay_id = ie.icustay_id) a
LEFT JOIN labevents le ON le.subject_id = a.subject_id AND le.hadm_id = a.hadm_id
 AND le.charttime BETWEEN a.suspected_infection_time - INTERVAL 48 HOUR AND a.suspected_infection_time""",
         ["suspicion", "icustays", "labevents"])


# ---------------------------------------------------------------------------
# panels (lineitem as lab log, part as dictionary)
_cte("panel_events", """
SELECT l_suppkey AS subject_id, l_partkey AS itemid,
       CASE WHEN l_discount = 0 THEN NULL ELSE l_quantity END AS valuenum,
       CASE WHEN l_tax = 0 THEN NULL ELSE l_returnflag END AS value
FROM lineitem""")
_cte("lab_dictionary", "SELECT p_partkey AS itemid, p_type AS label FROM part")

register("group_stats", """
SELECT subject_id, round(avg(valuenum), 6) AS econ_avg, max(valuenum) AS econ_max,
       min(valuenum) AS econ_min, round(coalesce(stddev_samp(valuenum), 0), 6) AS econ_stddev
FROM panel_events
WHERE itemid IN (SELECT itemid FROM lab_dictionary WHERE lower(label) LIKE '%econ%')
  AND valuenum IS NOT NULL
GROUP BY subject_id""", ["panel_events", "lab_dictionary"])

_PANELS = [("econ", "lower(label) LIKE '%econ%'", "valuenum"),
           ("promo", "lower(label) LIKE '%promo%'", "valuenum"),
           ("standard", "lower(label) LIKE '%standard%'", "valuenum"),
           ("ar", "lower(label) LIKE '%ar%'", "valuenum"),
           ("medium", "label IN ('MEDIUM')", "value")]
for _n, _cond, _col in _PANELS:
    _cte(f"p_{_n}", f"""
SELECT subject_id, avg(valuenum) AS {_n}_avg, max(valuenum) AS {_n}_max,
       min(valuenum) AS {_n}_min, coalesce(stddev_samp(valuenum), 0) AS {_n}_stddev
FROM panel_events WHERE itemid IN (SELECT itemid FROM lab_dictionary WHERE {_cond})
  AND {_col} IS NOT NULL GROUP BY subject_id""", ["panel_events", "lab_dictionary"])
_panel_cols = ",\n  ".join(
    f"round(p_{n}.{n}_avg, 6) AS {n}_avg, p_{n}.{n}_max AS {n}_max, p_{n}.{n}_min AS {n}_min, "
    f"round(p_{n}.{n}_stddev, 6) AS {n}_stddev" for n, _, _ in _PANELS)
_panel_joins = "\n".join(f"LEFT JOIN p_{n} ON p_{n}.subject_id = s.subject_id" for n, _, _ in _PANELS)
_panel_union = " UNION ".join(f"SELECT subject_id FROM p_{n}" for n, _, _ in _PANELS)
register("panel_stats", f"""
SELECT s.subject_id,
  {_panel_cols}
FROM ({_panel_union}) s
{_panel_joins}""", [f"p_{n}" for n, _, _ in _PANELS])

# ---------------------------------------------------------------------------
# static features, demographics
_cte("static", """
SELECT subject_id, hadm_id, icustay_id, gender, admittime, CAST(round(years, 4) AS DOUBLE) AS admission_age,
       ethnicity, admission_type, admission_location, first_careunit,
       nth_admission AS hospstay_seq, CAST(nth_admission = 1 AS INTEGER) AS first_hosp_stay, intime, outtime,
       nth_stay AS icustay_seq, CAST(nth_stay = 1 AS INTEGER) AS first_icu_stay
FROM (SELECT s.*, p.gender, h.admittime, h.ethnicity, h.admission_type, h.admission_location,
             CAST(CAST(date_diff('second', p.dob, h.admittime) AS DOUBLE) / 31556908.8 AS DECIMAL(38, 9)) AS years,
             dense_rank() OVER by_patient AS nth_admission, dense_rank() OVER by_admission AS nth_stay
      FROM (SELECT * FROM admissions WHERE has_chartevents_data = 1) h
      JOIN icustays s ON s.hadm_id = h.hadm_id
      JOIN (SELECT subject_id, gender, dob FROM patients) p ON p.subject_id = s.subject_id
      WINDOW by_patient AS (PARTITION BY h.subject_id ORDER BY h.admittime NULLS FIRST),
             by_admission AS (PARTITION BY s.hadm_id ORDER BY s.intime NULLS FIRST))""",
     ["icustays", "admissions", "patients"])
register("static_features", "SELECT * FROM static", ["static"])


def _demographics_sql(with_dx: bool) -> str:
    return f"""
SELECT subject_id, gender, dob, dod, ethnicity, marital_status, insurance, los, admit_time,
       date_diff('year', dob, admit_time) AS age_admit, date_diff('year', dob, dod) AS age_death
FROM (SELECT DISTINCT subject_id, gender, dob, dod FROM patients
      WHERE subject_id {"IN" if with_dx else "NOT IN"} (SELECT subject_id FROM dx))
JOIN (SELECT subject_id, min(admittime) AS admit_time,
             CAST(sum(date_diff('day', admittime, dischtime)) AS BIGINT) AS los
      FROM admissions GROUP BY subject_id) USING (subject_id)
JOIN (SELECT DISTINCT subject_id, ethnicity, marital_status, insurance FROM admissions) USING (subject_id)"""


_cte("dx", "SELECT DISTINCT subject_id FROM diagnoses WHERE icd9_code IN ('1-URGENT')", ["diagnoses"])
register("demographics_with", _demographics_sql(True), ["patients", "admissions", "dx"])
register("demographics_without", _demographics_sql(False), ["patients", "admissions", "dx"])

# ---------------------------------------------------------------------------
# recodes and encodings
_RECODE = ("CASE WHEN contains(c_mktsegment, 'HOUSE') THEN 'House' WHEN contains(c_mktsegment, 'AUTO') THEN 'Auto' "
           "WHEN contains(c_mktsegment, 'BUILD') THEN 'Build' WHEN contains(c_mktsegment, 'O') THEN 'O' "
           "ELSE 'Other' END")
_VOCAB = ["Auto", "Build", "House", "O", "Other"]
register("recode_one_hot", f"""
SELECT c_custkey, eth AS ethnicity, {", ".join(f"CAST(eth = '{v}' AS INTEGER) AS {v}" for v in _VOCAB)}
FROM (SELECT c_custkey, {_RECODE} AS eth FROM customer) r""", [])
register("label_encode", """
SELECT c_custkey, c_mktsegment, dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS segment_code
FROM customer""", [])

# ---------------------------------------------------------------------------
# splits and folds
register("stratified_split", """
SELECT doc_id, quality, toxic, CAST(ix < CAST(round(nl * 0.1) AS BIGINT) AS INTEGER) AS is_test
FROM (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY md5('42|' || CAST(doc_id AS VARCHAR)), doc_id) - 1 AS ix,
             count(*) OVER (PARTITION BY quality) AS nl
      FROM labels) t""", [])
register("random_split", """
SELECT doc_id, quality, toxic,
       CAST(CAST(('0x' || substr(md5('0|' || CAST(doc_id AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0 < 0.25
            AS INTEGER) AS is_test
FROM labels""", [])
register("stratified_folds", """
SELECT doc_id, quality, toxic,
       CAST((row_number() OVER (PARTITION BY quality ORDER BY md5('42|' || CAST(doc_id AS VARCHAR)), doc_id) - 1) % 5
            AS INTEGER) AS fold
FROM labels""", [])

# ---------------------------------------------------------------------------
# evaluation
_cte("scored", """
SELECT l.doc_id, l.quality AS y, CAST(d.n_chars AS DOUBLE) / (CAST(d.n_chars AS DOUBLE) + 2000.0) AS p
FROM labels l JOIN documents d ON l.doc_id = d.doc_id""")
_cte("sc_g", """
SELECT p AS score, CAST(sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
       CAST(sum(CASE WHEN y != 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp
FROM scored WHERE p IS NOT NULL AND y IS NOT NULL GROUP BY p""", ["scored"])
_cte("sc_c", """
SELECT *, CAST(sum(tp) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum_tp,
       CAST(sum(fp) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum_fp,
       row_number() OVER (ORDER BY score DESC) - 1 AS idx,
       lead(tp) OVER (ORDER BY score DESC) AS ntp, lead(fp) OVER (ORDER BY score DESC) AS nfp,
       (SELECT CAST(sum(tp) AS DOUBLE) FROM sc_g) AS npos, (SELECT CAST(sum(fp) AS DOUBLE) FROM sc_g) AS nneg
FROM sc_g""", ["sc_g"])
_cte("sc_pr", """
SELECT * FROM sc_c WHERE score >= (SELECT max(score) FROM sc_c WHERE cum_tp >= npos)""", ["sc_c"])
_cte("tm", """
SELECT CAST(sum(CASE WHEN p > 0.5 AND y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
       CAST(sum(CASE WHEN p > 0.5 AND NOT (y = 1) THEN 1 ELSE 0 END) AS BIGINT) AS fp,
       CAST(sum(CASE WHEN NOT (p > 0.5) AND y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
       CAST(sum(CASE WHEN NOT (p > 0.5) AND NOT (y = 1) THEN 1 ELSE 0 END) AS BIGINT) AS tn
FROM scored""", ["scored"])
_TM_COLS = """round(CASE WHEN tp + fp + fn + tn = 0 THEN 0.0 ELSE CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn) END, 9) AS accuracy,
       round(CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END, 9) AS precision,
       round(CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END, 9) AS recall,
       round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) END, 9) AS f1"""
register("threshold_metrics", f"SELECT {_TM_COLS} FROM tm", ["tm"])
register("roc_curve", """
SELECT CAST('inf' AS DOUBLE) AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
UNION ALL
SELECT score, round(cum_fp / nneg, 9), round(cum_tp / npos, 9) FROM sc_c
WHERE idx = 0 OR ntp IS NULL OR ntp != tp OR nfp != fp""", ["sc_c"])
_ROC_AUC = "round(sum(fp / nneg * (cum_tp / npos + (cum_tp - tp) / npos) / 2.0), 9)"
_PR_AUC = ("round(sum(tp / npos * (CAST(cum_tp AS DOUBLE) / (cum_tp + cum_fp) + "
           "CASE WHEN (cum_tp - tp) + (cum_fp - fp) = 0 THEN 1.0 "
           "ELSE CAST(cum_tp - tp AS DOUBLE) / ((cum_tp - tp) + (cum_fp - fp)) END) / 2.0), 9)")
register("roc_auc", f"SELECT {_ROC_AUC} AS roc_auc FROM sc_c", ["sc_c"])
register("pr_curve", """
SELECT score AS threshold, round(cum_tp / npos, 9) AS recall,
       round(CAST(cum_tp AS DOUBLE) / (cum_tp + cum_fp), 9) AS precision
FROM sc_pr
UNION ALL SELECT NULL, 0.0, 1.0""", ["sc_pr"])
register("pr_auc", f"SELECT {_PR_AUC} AS pr_auc FROM sc_pr", ["sc_pr"])
register("classification_metrics", f"""
SELECT m.accuracy, r.roc_auc, p.pr_auc, m.precision, m.recall, m.f1
FROM (SELECT {_TM_COLS} FROM tm) m, (SELECT {_ROC_AUC} AS roc_auc FROM sc_c) r,
     (SELECT {_PR_AUC} AS pr_auc FROM sc_pr) p""", ["tm", "sc_c", "sc_pr"])
_cte("fold_preds", """
SELECT f.doc_id, m.model,
       (f.p * 2000.0 / (1.0 - f.p) + CAST(m.model AS DOUBLE) * 100.0)
       / (f.p * 2000.0 / (1.0 - f.p) + CAST(m.model AS DOUBLE) * 100.0 + 2000.0) AS p_model
FROM scored f CROSS JOIN (SELECT range AS model FROM range(5)) m""", ["scored"])
register("ensemble_mean", "SELECT doc_id, round(avg(p_model), 9) AS p_mean FROM fold_preds GROUP BY doc_id",
         ["fold_preds"])
register("cv_band", """
SELECT CAST(model AS INTEGER) AS model, round(avg(p_model), 9) AS mean, round(stddev_pop(p_model), 9) AS sd,
       round(avg(p_model) - 1.96 * stddev_pop(p_model), 9) AS lower,
       round(avg(p_model) + 1.96 * stddev_pop(p_model), 9) AS upper
FROM fold_preds GROUP BY model""", ["fold_preds"])
register("weighted_mean", """
SELECT l_returnflag, round(sum(l_extendedprice * l_quantity) / sum(l_quantity), 4) AS weighted_mean
FROM lineitem GROUP BY l_returnflag""", [])
register("topk_sorted", """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 10""", [])

# ---------------------------------------------------------------------------
# set and join forms
register("not_in", """
SELECT c_custkey, c_mktsegment FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P')""", [])
register("anti_missing", """
SELECT a.subject_id, a.gender FROM patients a LEFT JOIN dx b ON a.subject_id = b.subject_id
WHERE b.subject_id IS NULL""", ["patients", "dx"])
register("semi_all", """
SELECT c_custkey, c_name FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
  AND c_custkey IN (SELECT user_id FROM events WHERE event_type = 'purchase')""", [])
register("concat_labelled", """
SELECT icustay_id, intime, outtime, length_of_stay, sepsis_onset, sepsis_onset_day, sepsis_onset_hour,
       subject_id, CAST(NULL AS BIGINT) AS hadm_id, 1 AS label FROM cases
UNION ALL
SELECT icustay_id, intime, outtime, length_of_stay, sepsis_onset, NULL, NULL, subject_id, hadm_id, 0
FROM controls""", ["cases", "controls"])
register("value_counts", "SELECT quality, toxic, count(*) AS count FROM labels GROUP BY quality, toxic", [])
register("distinct_keys", "SELECT DISTINCT o_custkey, o_orderpriority FROM orders", [])

# ---------------------------------------------------------------------------
# scalar functions
register("scalar_time", """
SELECT l_orderkey, l_linenumber,
       date_diff('second', o_orderdate, l_shipdate) AS d_seconds,
       round(CAST(date_diff('second', o_orderdate, l_shipdate) AS DOUBLE) / 3600.0, 6) AS d_hours,
       date_diff('hour', o_orderdate, l_shipdate) AS d_hour_boundaries,
       date_diff('day', o_orderdate, l_shipdate) AS d_days,
       date_diff('year', o_orderdate, l_shipdate) AS d_years,
       o_orderdate - INTERVAL 48 HOUR AS minus_48h,
       o_orderdate + to_microseconds(CAST(round(l_linenumber * 1.25 * 3600000000.0) AS BIGINT)) AS plus_frac,
       l_shipdate BETWEEN o_orderdate + INTERVAL 720 HOUR AND o_orderdate + INTERVAL 2160 HOUR AS ships_1_3_months
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""", [])
register("scalar_misc", """
SELECT c_custkey,
       round(c_acctbal / 365.242, 4) AS r4,
       CAST(round(CAST(c_acctbal AS DECIMAL(38, 9)), 4) AS DOUBLE) AS num4,
       CASE WHEN c_acctbal / 100.0 > 89 THEN 91.4 ELSE c_acctbal / 100.0 END AS topcoded,
       substr(c_mktsegment, 1, 1) || lower(substr(c_mktsegment, 2)) AS cap,
       lower(c_name) LIKE '%1%' AS name_has_1,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'Yes' ELSE 'No' END AS is_building,
       CAST(45 - ceil(c_acctbal / 250.0) AS BIGINT) AS rev_hour,
       round(1.0 / (1.0 + exp(-(c_acctbal / 1000.0))), 9) AS sig,
       CAST(1.0 / (1.0 + exp(-(c_acctbal / 1000.0))) > 0.5 AS INTEGER) AS pos,
       round(c_acctbal / 1000.0 - 1.96 * 0.5, 9) AS band_lo,
       round(c_acctbal / 1000.0 + 1.96 * 0.5, 9) AS band_hi,
       CASE WHEN c_nationkey = 0 THEN NULL ELSE c_acctbal / c_nationkey END AS per_nation
FROM customer""", [])

# ---------------------------------------------------------------------------
# series-derived frames
LABC = ["C0", "C1", "C2", "C3", "C4", "V0", "V1", "V2"]
VITC = ["HeartRate", "SpO2", "TempC", "SVV", "FiO2"]
_cte("labs_case48", lab_series_sql("cases", "sepsis_onset", 48), ["cases", "labevents", "icustays"])
_cte("vits_case48", vital_series_sql("cases", "sepsis_onset", 48), ["cases", "chartevents", "icustays"])
_cte("labs_ctrl48", lab_series_sql("matched", "control_onset_time", 48), ["matched", "labevents", "icustays"])
_cte("vits_ctrl48", vital_series_sql("matched", "control_onset_time", 48), ["matched", "chartevents", "icustays"])


def _rnd(cols, digits=6, prefix=""):
    return ", ".join(f"round({prefix}{c}, {digits}) AS {c}" for c in cols)


_STATS5 = []
for _c in LABC:
    _STATS5 += [f"round(avg({_c}), 6) AS {_c}_mean", f"round(median({_c}), 6) AS {_c}_median",
                f"round(stddev_samp({_c}), 6) AS {_c}_std", f"min({_c}) AS {_c}_min", f"max({_c}) AS {_c}_max"]
register("agg_features", f"SELECT icustay_id, {', '.join(_STATS5)} FROM labs_case48 GROUP BY icustay_id",
         ["labs_case48"])


def _hourly_sql(series: str, anchors: str, anchor_col: str, cols) -> str:
    hrs = f"CAST(date_diff('second', s.chart_time, a.{anchor_col}) AS DOUBLE) / 3600.0 - 3.0"
    avgs = ", ".join(f"round(avg({c}), 6) AS {c}" for c in cols)
    return f"""
SELECT icustay_id, hr, {avgs}
FROM (SELECT s.*, CAST(45 - ceil({hrs}) AS BIGINT) AS hr
      FROM {series} s JOIN {anchors} a ON s.icustay_id = a.icustay_id
      WHERE {hrs} >= 0) t
GROUP BY icustay_id, hr"""


_cte("hl_case", _hourly_sql("labs_case48", "cases", "sepsis_onset", LABC), ["labs_case48", "cases"])
_cte("hv_case", _hourly_sql("vits_case48", "cases", "sepsis_onset", VITC), ["vits_case48", "cases"])
_cte("hl_ctrl", _hourly_sql("labs_ctrl48", "matched", "control_onset_time", LABC), ["labs_ctrl48", "matched"])
_cte("hv_ctrl", _hourly_sql("vits_ctrl48", "matched", "control_onset_time", VITC), ["vits_ctrl48", "matched"])


def _merge_sql(hl: str, hv: str) -> str:
    return f"""
SELECT coalesce(l.icustay_id, v.icustay_id) AS icustay_id, coalesce(l.hr, v.hr) AS hr,
       {", ".join(f"l.{c}" for c in LABC)}, {", ".join(f"v.{c}" for c in VITC)}
FROM {hl} l FULL OUTER JOIN {hv} v ON l.icustay_id = v.icustay_id AND l.hr = v.hr"""


_cte("merged_case", _merge_sql("hl_case", "hv_case"), ["hl_case", "hv_case"])
_cte("merged_ctrl", _merge_sql("hl_ctrl", "hv_ctrl"), ["hl_ctrl", "hv_ctrl"])


def _ffill_sql(src: str, extra: str = "") -> str:
    fills = ", ".join(
        f"coalesce(last_value({c} IGNORE NULLS) OVER (PARTITION BY icustay_id ORDER BY hr "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0) AS {c}" for c in LABC + VITC)
    return f"SELECT icustay_id, hr{extra}, {fills} FROM {src}"


register("hourly_mean", "SELECT * FROM hl_case", ["hl_case"])
register("hourly_outer_merge", "SELECT * FROM merged_case", ["merged_case"])
register("forward_fill", _ffill_sql("merged_case"), ["merged_case"])
_cte("seq_all", """
SELECT *, 1 AS label FROM merged_case
WHERE icustay_id IN (SELECT icustay_id FROM hl_case) AND icustay_id IN (SELECT icustay_id FROM hv_case)
UNION ALL
SELECT *, 0 AS label FROM merged_ctrl
WHERE icustay_id IN (SELECT icustay_id FROM hl_ctrl) AND icustay_id IN (SELECT icustay_id FROM hv_ctrl)""",
     ["merged_case", "merged_ctrl", "hl_case", "hv_case", "hl_ctrl", "hv_ctrl"])
register("sequence_frame", _ffill_sql("seq_all", ", label"), ["seq_all"])

# wide per-stay frame: imputation and scaling
FEATS = [f"{c}_{s}" for c in LABC for s in ("mean", "max")]
_cte("wide", "SELECT icustay_id, " + ", ".join(
    f"avg({c}) AS {c}_mean, max({c}) AS {c}_max" for c in LABC) + " FROM labs_case48 GROUP BY icustay_id",
     ["labs_case48"])
register("impute_median", "SELECT icustay_id, " + ", ".join(
    f"round(coalesce({f}, (SELECT median({f}) FROM wide)), 6) AS {f}" for f in FEATS) + " FROM wide", ["wide"])
_cte("wide_split", """
SELECT *, CAST(CAST(('0x' || substr(md5('0|' || CAST(icustay_id AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0 < 0.25
               AS INTEGER) AS is_test
FROM wide""", ["wide"])
_cte("wide_stats", "SELECT " + ", ".join(f"min({f}) AS min_{f}, max({f}) AS max_{f}" for f in FEATS)
     + " FROM wide_split WHERE is_test = 0", ["wide_split"])
register("minmax_scale", "SELECT icustay_id, is_test, " + ", ".join(
    f"round(({f} - min_{f}) / CASE WHEN max_{f} - min_{f} = 0 THEN 1.0 ELSE max_{f} - min_{f} END, 6) AS {f}"
    for f in FEATS) + " FROM wide_split, wide_stats", ["wide_split", "wide_stats"])
register("static_measure_merge", """
SELECT st.icustay_id, st.gender, st.admission_age, round(l.C0_mean, 6) AS C0_mean, round(l.V0_mean, 6) AS V0_mean,
       round(v.HeartRate_mean, 6) AS HeartRate_mean
FROM (SELECT * FROM static WHERE icustay_id IN (SELECT icustay_id FROM cases)) st
JOIN (SELECT icustay_id, avg(C0) AS C0_mean, avg(V0) AS V0_mean FROM labs_case48 GROUP BY icustay_id) l
  ON st.icustay_id = l.icustay_id
JOIN (SELECT icustay_id, avg(HeartRate) AS HeartRate_mean FROM vits_case48 GROUP BY icustay_id) v
  ON st.icustay_id = v.icustay_id""", ["static", "cases", "labs_case48", "vits_case48"])

# model frame and Table 1
_RECODE_ETH = _RECODE.replace("c_mktsegment", "ethnicity")
_cte("mf", f"""
SELECT icustay_id, gender, admission_age, 1 AS label, {_RECODE_ETH} AS eth
FROM static WHERE icustay_id IN (SELECT icustay_id FROM cases)
UNION ALL
SELECT icustay_id, gender, admission_age, 0 AS label, {_RECODE_ETH} AS eth
FROM static WHERE icustay_id IN (SELECT icustay_id FROM matched)""", ["static", "cases", "matched"])
register("model_frame", f"""
SELECT icustay_id, admission_age, label, {", ".join(f"CAST(eth = '{v}' AS INTEGER) AS {v}" for v in _VOCAB)},
       dense_rank() OVER (ORDER BY gender) - 1 AS gender,
       CAST(row_number() OVER (PARTITION BY label ORDER BY md5('42|' || CAST(icustay_id AS VARCHAR)), icustay_id) - 1
            < CAST(round(count(*) OVER (PARTITION BY label) * 0.1) AS BIGINT) AS INTEGER) AS is_test
FROM mf""", ["mf"])


# both arms, all measures per subject, with the static rows
def _measured(series: str, cols) -> str:
    stats = ", ".join(f"avg({c}) AS {c}_mean, median({c}) AS {c}_median, stddev_samp({c}) AS {c}_std" for c in cols)
    return f"(SELECT subject_id, {stats} FROM {series} GROUP BY subject_id)"


def _arm_sql(ids: str, labs: str, vits: str, label: int) -> str:
    return f"""
SELECT st.icustay_id, {label} AS label, st.gender, st.admission_age, {_RECODE_ETH} AS ethnicity,
       l.* EXCLUDE (subject_id), v.* EXCLUDE (subject_id)
FROM static st JOIN {_measured(labs, LABC)} l ON l.subject_id = st.subject_id
     JOIN {_measured(vits, VITC)} v ON v.subject_id = st.subject_id
WHERE st.icustay_id IN (SELECT icustay_id FROM {ids})"""


ARM_FEATS = [f"{c}_{s}" for c in LABC + VITC for s in ("mean", "median", "std")]
_cte("arms", _arm_sql("cases", "labs_case48", "vits_case48", 1) + "\nUNION ALL"
     + _arm_sql("matched", "labs_ctrl48", "vits_ctrl48", 0),
     ["static", "cases", "matched", "labs_case48", "vits_case48", "labs_ctrl48", "vits_ctrl48"])
register("static_measure_merge_arms", f"SELECT icustay_id, label, gender, admission_age, ethnicity, {_rnd(ARM_FEATS)} FROM arms",
         ["arms"])
register("impute_median_arms", "SELECT icustay_id, label, " + ", ".join(
    f"round(coalesce({f}, (SELECT median({f}) FROM arms)), 6) AS {f}" for f in ARM_FEATS) + " FROM arms", ["arms"])
_cte("arms_split", """
SELECT *, CAST(CAST(('0x' || substr(md5('0|' || CAST(icustay_id AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0 < 0.25
               AS INTEGER) AS is_test
FROM arms""", ["arms"])
_cte("arms_stats", "SELECT " + ", ".join(f"min({f}) AS min_{f}, max({f}) AS max_{f}" for f in ARM_FEATS)
     + " FROM arms_split WHERE is_test = 0", ["arms_split"])
register("minmax_scale_arms", "SELECT icustay_id, label, is_test, " + ", ".join(
    f"round(({f} - min_{f}) / CASE WHEN max_{f} - min_{f} = 0 THEN 1.0 ELSE max_{f} - min_{f} END, 6) AS {f}"
    for f in ARM_FEATS) + " FROM arms_split, arms_stats", ["arms_split", "arms_stats"])


def _pop_part(static_ids: str, labs: str, vits: str, flag: str, prio: int) -> str:
    return f"""
SELECT subject_id, admission_age, CASE WHEN gender = 'F' THEN 'Female' ELSE 'Male' END AS gender,
       {_RECODE_ETH} AS ethnicity, '{flag}' AS sepsis, {prio} AS prio
FROM (SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY admission_age NULLS FIRST, icustay_id) AS rn
      FROM static WHERE icustay_id IN (SELECT icustay_id FROM {static_ids})) t
WHERE rn = 1
  AND subject_id IN (SELECT subject_id FROM {labs} WHERE chart_time IS NOT NULL)
  AND subject_id IN (SELECT subject_id FROM {vits})"""


_cte("pop", f"""
SELECT subject_id, admission_age, gender, ethnicity, sepsis
FROM (SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY prio) AS r
      FROM ({_pop_part("cases", "labs_case48", "vits_case48", "Yes", 0)}
            UNION ALL {_pop_part("matched", "labs_ctrl48", "vits_ctrl48", "No", 1)}) u) v
WHERE r = 1""", ["static", "cases", "matched", "labs_case48", "vits_case48", "labs_ctrl48", "vits_ctrl48"])
register("summary_population", "SELECT * FROM pop", ["pop"])
register("summary_categorical", """
WITH base AS (SELECT 'gender' AS variable, gender AS level, sepsis AS grp FROM pop WHERE gender IS NOT NULL
              UNION ALL SELECT 'ethnicity', ethnicity, sepsis FROM pop WHERE ethnicity IS NOT NULL),
     per AS (SELECT variable, level, grp, count(*) AS n FROM base GROUP BY variable, level, grp),
     allg AS (SELECT variable, level, grp, n FROM per
              UNION ALL SELECT variable, level, 'Overall', CAST(sum(n) AS BIGINT) FROM per GROUP BY variable, level)
SELECT variable, level, grp, CAST(n AS BIGINT) AS n,
       round(CAST(n AS DOUBLE) * 100.0 / sum(n) OVER (PARTITION BY variable, grp), 6) AS pct
FROM allg""", ["pop"])
register("summary_numeric", """
SELECT 'admission_age' AS variable, grp, count(v) AS n, round(quantile_cont(v, 0.5), 6) AS median,
       round(quantile_cont(v, 0.25), 6) AS q1, round(quantile_cont(v, 0.75), 6) AS q3
FROM (SELECT CAST(admission_age AS DOUBLE) AS v, sepsis AS grp FROM pop
      UNION ALL SELECT CAST(admission_age AS DOUBLE), 'Overall' FROM pop) t
GROUP BY grp""", ["pop"])


def _chi2_sql(col: str, digits: int = 6) -> str:
    return f"""
SELECT '{col}' AS variable, round(sum((oc - e) * (oc - e) / e), {digits}) AS statistic, max(dof) AS dof
FROM (SELECT *, CASE WHEN dof = 1 THEN o + sign(e - o) * least(0.5, abs(e - o)) ELSE o END AS oc
      FROM (SELECT lvl, grp, CAST(o AS DOUBLE) AS o,
                   CAST(sum(o) OVER (PARTITION BY lvl) AS DOUBLE) * sum(o) OVER (PARTITION BY grp)
                     / sum(o) OVER () AS e,
                   CAST(((SELECT count(DISTINCT {col}) FROM pop WHERE {col} IS NOT NULL AND sepsis IS NOT NULL) - 1)
                        * ((SELECT count(DISTINCT sepsis) FROM pop WHERE {col} IS NOT NULL AND sepsis IS NOT NULL) - 1)
                        AS BIGINT) AS dof
            FROM (SELECT l.lvl, g.grp, coalesce(ct.o, 0) AS o
                  FROM (SELECT DISTINCT CAST({col} AS VARCHAR) AS lvl FROM pop WHERE {col} IS NOT NULL AND sepsis IS NOT NULL) l
                  CROSS JOIN (SELECT DISTINCT CAST(sepsis AS VARCHAR) AS grp FROM pop WHERE {col} IS NOT NULL AND sepsis IS NOT NULL) g
                  LEFT JOIN (SELECT CAST({col} AS VARCHAR) AS lvl, CAST(sepsis AS VARCHAR) AS grp, count(*) AS o
                             FROM pop WHERE {col} IS NOT NULL AND sepsis IS NOT NULL GROUP BY 1, 2) ct
                    ON ct.lvl = l.lvl AND ct.grp = g.grp) grid) x) y"""


register("chi2_stat", f"{_chi2_sql('gender')}\nUNION ALL\n{_chi2_sql('ethnicity')}", ["pop"])
_KRUSKAL = """
WITH b AS (SELECT CAST(admission_age AS DOUBLE) AS v, sepsis AS g FROM pop
           WHERE admission_age IS NOT NULL AND sepsis IS NOT NULL),
     r AS (SELECT v, g, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0 AS rk FROM b),
     s AS (SELECT g, sum(rk) AS rs, count(*) AS n FROM r GROUP BY g),
     t AS (SELECT sum(CAST(c AS DOUBLE) * c * c - c) AS ts FROM (SELECT count(*) AS c FROM b GROUP BY v) q),
     h AS (SELECT 12.0 / (sum(n) * (sum(n) + 1)) * sum(rs * rs / n) - 3.0 * (sum(n) + 1) AS h,
                  count(*) AS k, CAST(sum(n) AS DOUBLE) AS nn FROM s)
SELECT 'admission_age' AS variable, round(h / (1.0 - ts / (nn * nn * nn - nn)), {digits}) AS statistic,
       CAST(k - 1 AS BIGINT) AS dof
FROM h, t"""
register("kruskal_stat", _KRUSKAL.format(digits=6), ["pop"])
# One minus the series of the lower incomplete gamma function, term by term from log-gammas.
register("summary_pvalues", f"""
SELECT variable, round(statistic, 6) AS statistic, dof,
       CASE WHEN x <= 0 THEN 1.0 ELSE round(1.0 - exp(a * ln(x) - x - lgamma(a + 1.0))
             * list_sum(list_transform(range(0, 400), lambda n: exp(n * ln(x) + lgamma(a + 1.0) - lgamma(a + n + 1.0)))), 6) END AS p_value
FROM (SELECT *, dof / 2.0 AS a, statistic / 2.0 AS x
      FROM ({_chi2_sql('gender', 14)}
            UNION ALL {_chi2_sql('ethnicity', 14)}
            UNION ALL ({_KRUSKAL.format(digits=14)})) u) v""", ["pop"])

register("window_join_96h", """
SELECT a.icustay_id, a.suspected_infection_time, a.subject_id, a.hadm_id,
       le.charttime, le.itemid, le.valuenum
FROM (SELECT s.icustay_id, s.suspected_infection_time, ie.subject_id, ie.hadm_id
      FROM suspicion s JOIN icustays ie ON s.icustay_id = ie.icustay_id) a
LEFT JOIN labevents le ON le.subject_id = a.subject_id AND le.hadm_id = a.hadm_id
 AND le.charttime BETWEEN a.suspected_infection_time - INTERVAL 96 HOUR AND a.suspected_infection_time""",
         ["suspicion", "icustays", "labevents"])
register("split_sequences", _ffill_sql("seq_all", ", label").replace("SELECT icustay_id, hr, label,", """
SELECT s.*, CAST(t.ix < CAST(round(t.nl * 0.1) AS BIGINT) AS INTEGER) AS is_test
FROM (SELECT icustay_id, hr, label,""", 1) + """) s
JOIN (SELECT icustay_id, row_number() OVER (PARTITION BY label ORDER BY md5('42|' || CAST(icustay_id AS VARCHAR)),
                                            icustay_id) - 1 AS ix,
             count(*) OVER (PARTITION BY label) AS nl
      FROM (SELECT DISTINCT icustay_id, label FROM seq_all) d) t ON s.icustay_id = t.icustay_id""", ["seq_all"])
register("roc_curve_auc", f"SELECT {_ROC_AUC} AS roc_auc FROM sc_c", ["sc_c"])

# ---------------------------------------------------------------------------
# per-fold scaling, matrices by cell, kept columns, ranks, stored tables
_cte("seq_filled", _ffill_sql("seq_all", ", label"), ["seq_all"])
_cte("seq_folds", """
SELECT icustay_id, CAST((row_number() OVER (PARTITION BY label ORDER BY h, icustay_id) - 1) % 5 AS INTEGER) AS fold
FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY h, icustay_id) - 1 AS ix, count(*) OVER (PARTITION BY label) AS nl
      FROM (SELECT DISTINCT icustay_id, label, md5('42|' || CAST(icustay_id AS VARCHAR)) AS h FROM seq_all) d) t
WHERE ix >= CAST(round(nl * 0.1) AS BIGINT)""", ["seq_all"])
_SEQC = ["hr", *LABC, *VITC]
register("fold_scaled_sequences", f"""
WITH base AS (SELECT f.*, t.fold FROM seq_filled f JOIN seq_folds t USING (icustay_id)),
     others AS (SELECT m.model, {", ".join(f"min({c}) AS min_{c}, max({c}) AS max_{c}" for c in _SEQC)}
                FROM base b JOIN (SELECT CAST(range AS INTEGER) AS model FROM range(5)) m ON b.fold <> m.model GROUP BY m.model)
SELECT o.model, CAST(b.fold = o.model AS INTEGER) AS is_valid, b.icustay_id, b.hr AS hour, b.label,
       {", ".join(f"round((b.{c} - o.min_{c}) / CASE WHEN o.max_{c} = o.min_{c} THEN 1.0 ELSE o.max_{c} - o.min_{c} END, 6) AS {c}" for c in _SEQC)}
FROM base b CROSS JOIN others o""", ["seq_filled", "seq_folds"])
_CELLS = f"[{', '.join(f'CAST({c} AS DOUBLE)' for c in _SEQC)}]"
_cte("seq_steps", f"""
SELECT icustay_id, CAST(count(*) OVER (PARTITION BY icustay_id) AS INTEGER) AS length,
       CAST(row_number() OVER (PARTITION BY icustay_id ORDER BY hr) - 1 AS INTEGER) AS step, {_CELLS} AS cells
FROM seq_filled""", ["seq_filled"])
register("sequence_cells", f"""
SELECT icustay_id, length, step, unnest(range(0, {len(_SEQC)}))::INTEGER AS feature, unnest(cells) AS value FROM seq_steps""", ["seq_steps"])
register("padded_cells", f"""
WITH stays AS (SELECT DISTINCT icustay_id, length FROM seq_steps),
     dealt AS (SELECT *, (row_number() OVER (ORDER BY md5('42|' || CAST(icustay_id AS VARCHAR)), icustay_id) - 1) // 8 AS batch FROM stays),
     placed AS (SELECT *, row_number() OVER (PARTITION BY batch ORDER BY length DESC, icustay_id) - 1 AS pos,
                       max(length) OVER (PARTITION BY batch) AS longest FROM dealt),
     grid AS (SELECT icustay_id, batch, pos, length, unnest(range(0, longest))::INTEGER AS step FROM placed)
SELECT g.icustay_id, g.batch, g.pos, g.length, g.step, unnest(range(0, {len(_SEQC)}))::INTEGER AS feature,
       unnest(coalesce(s.cells, [0.0::DOUBLE for x in range(0, {len(_SEQC)})])) AS value
FROM grid g LEFT JOIN seq_steps s USING (icustay_id, step)""", ["seq_steps"])
register("kept_columns", f"""
SELECT measure, round(f, 6) AS fraction, f >= 0.5 AS kept
FROM (SELECT unnest([{", ".join(f"'{f}'" for f in ARM_FEATS)}]) AS measure,
             unnest([{", ".join(f"count({f}) / CAST(count(*) AS DOUBLE)" for f in ARM_FEATS)}]) AS f FROM arms) t""", ["arms"])
register("average_rank", """
SELECT o_orderkey, o_orderpriority, price,
       rank() OVER (PARTITION BY o_orderpriority ORDER BY price)
         + (count(*) OVER (PARTITION BY o_orderpriority, price) - 1) / 2.0::DOUBLE AS rank
FROM (SELECT o_orderkey, o_orderpriority, CAST(floor(o_totalprice / 1000) AS BIGINT) AS price FROM orders) o""", [])
register("matched_controls_table", "SELECT * FROM matched", ["matched"])
register("bucketed_lab_stats", """
SELECT l.hadm_id, round(avg(valuenum), 6) AS lab_avg, max(valuenum) AS lab_max, min(valuenum) AS lab_min,
       round(coalesce(stddev_samp(valuenum), 0.0), 6) AS lab_stddev
FROM labevents l JOIN admissions a ON a.hadm_id = l.hadm_id AND l.charttime >= a.admittime
WHERE valuenum IS NOT NULL GROUP BY l.hadm_id""", ["labevents", "admissions"])
register("derived_tables", """
SELECT icustay_id, suspected_infection_time AS at, 'suspicion' AS source_table FROM suspicion
UNION ALL SELECT icustay_id, endtime, 'scores' FROM scores""", ["suspicion", "scores"])
register("curve_csv", f"SELECT fpr, tpr FROM ({BODIES['roc_curve'][0]}) c", ["sc_c"])

# ---------------------------------------------------------------------------
# the clinical item tables, as rows to join


def _lit(v) -> str:
    return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)


def _values(rows, *cols: str) -> str:
    return f"(VALUES {', '.join('(' + ', '.join(_lit(v) for v in r) + ')' for r in rows)}) v({', '.join(cols)})"


def _real_items(log: str, items) -> str:
    return f"SELECT * REPLACE (([{', '.join(map(str, items))}])[itemid % {len(items)} + 1]::BIGINT AS itemid) FROM {log}"


def _cleaned_labs(labels, bounds, log: str) -> str:
    """Labelled labs, NULL where the value lies outside the limits of its item."""
    return f"""
SELECT l.*, m.label AS kind, CASE WHEN l.valuenum < b.low OR l.valuenum > b.high THEN NULL ELSE l.valuenum END AS amount
FROM ({log}) l JOIN (SELECT * FROM {_values(labels, "itemid", "label")}) m USING (itemid)
LEFT JOIN (SELECT itemid, low::DOUBLE AS low, high::DOUBLE AS high FROM {_values(bounds, "itemid", "low", "high")}) b USING (itemid)
WHERE l.valuenum > 0"""


_cte("real_labs", _cleaned_labs(specs.LAB_LABELS, specs.LAB_SERIES_BOUNDS,
                                _real_items("labevents", [i for i, _ in specs.LAB_LABELS] + specs.LAB_UNLABELLED)), ["labevents"])
register("clinical_lab_series", _series_sql(
    "cases", "sepsis_onset", 48, "LEFT JOIN", "SELECT *, charttime AS taken FROM real_labs",
    "m.hadm_id = w.hadm_id AND m.subject_id = w.subject_id", {c: f"'{c}'" for c in specs.LAB_COLUMNS}), ["cases", "real_labs", "icustays"])
_RULE_ROWS = [(i, lo, int(lo_in), hi, int(hi_in), mid) for ids, lo, lo_in, hi, hi_in, mid in specs.VITAL_RULES for i in ids]
_SHOWN = [mid for mid, _ in specs.VITAL_COLUMNS]
_cte("real_vitals", f"""
SELECT c.*, CASE WHEN coalesce(CASE WHEN r.low_in = 1 THEN c.valuenum >= r.low ELSE c.valuenum > r.low END, r.low IS NULL)
                  AND coalesce(CASE WHEN r.high_in = 1 THEN c.valuenum <= r.high ELSE c.valuenum < r.high END, r.high IS NULL)
             THEN r.measure END AS kind,
       CASE WHEN itemid IN ({", ".join(map(str, specs.VITAL_FAHRENHEIT))}) THEN (c.valuenum - 32) / 1.8 ELSE c.valuenum END AS amount
FROM ({_real_items("chartevents", specs.VITAL_ITEMS)}) c
JOIN (SELECT itemid, low::DOUBLE AS low, low_in, high::DOUBLE AS high, high_in, measure
      FROM {_values(_RULE_ROWS, "itemid", "low", "low_in", "high", "high_in", "measure")}) r USING (itemid)
WHERE c.error = 0 AND r.measure IN ({", ".join(map(str, _SHOWN))})""", ["chartevents"])
_VITAL_SERIES = _series_sql("cases", "sepsis_onset", 48, "JOIN", "SELECT *, charttime AS taken FROM real_vitals",
                            "m.icustay_id = w.icustay_id", {n: str(i) for i, n in specs.VITAL_COLUMNS})
register("clinical_vital_series", f"SELECT * REPLACE (round(TempC, 9) AS TempC) FROM ({_VITAL_SERIES}) s", ["cases", "real_vitals", "icustays"])
_cte("hourly_labs", _cleaned_labs(specs.HOURLY_LAB_LABELS, specs.HOURLY_LAB_BOUNDS, _real_items("labevents", specs.HOURLY_LAB_ITEMS)), ["labevents"])
register("clinical_lab_events", """
SELECT s.icustay_id, l.kind AS label, l.charttime, l.amount AS valuenum
FROM suspicion s JOIN icustays i ON i.icustay_id = s.icustay_id JOIN hourly_labs l ON l.hadm_id = i.hadm_id
WHERE l.amount IS NOT NULL AND l.charttime BETWEEN s.suspected_infection_time - INTERVAL 48 HOUR AND s.suspected_infection_time""",
         ["suspicion", "icustays", "hourly_labs"])
_PANEL_ROWS = ["(lower(label) LIKE '%" + pat.lower() + "%')" if kind == "like" else f"(label = '{pat}')" for _, kind, pat, _ in specs.LAB_PANELS]
_PANEL_COLS = ", ".join(
    f"round(avg(valuenum) FILTER (panel = '{n}'), 6) AS {n}_avg, max(valuenum) FILTER (panel = '{n}') AS {n}_max, "
    f"min(valuenum) FILTER (panel = '{n}') AS {n}_min, round(CASE WHEN count(*) FILTER (panel = '{n}') > 0 THEN "
    f"coalesce(stddev_samp(valuenum) FILTER (panel = '{n}'), 0.0) END, 6) AS {n}_stddev" for n, *_ in specs.LAB_PANELS)
register("clinical_panels", f"""
WITH dictionary AS (SELECT p_partkey AS itemid, ([{", ".join(_lit(x) for x in CLINICAL_ITEM_LABELS)}])[p_partkey % {len(CLINICAL_ITEM_LABELS)} + 1] AS label FROM part),
     members AS ({" UNION ALL ".join(f"SELECT itemid, '{n}' AS panel, '{col}' AS needs FROM dictionary WHERE {cond}" for (n, _, _, col), cond in zip(specs.LAB_PANELS, _PANEL_ROWS, strict=True))})
SELECT subject_id, {_PANEL_COLS}
FROM panel_events e JOIN members m USING (itemid)
WHERE CASE WHEN needs = 'value' THEN e.value IS NOT NULL ELSE e.valuenum IS NOT NULL END
GROUP BY subject_id""", ["panel_events"])
