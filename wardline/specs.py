"""Item tables as data.

The operators in ``wardline.operators.measures`` take any spec; the tables
below are the clinical ones the extraction queries of the original
workflow use on the public ICU database (item ids of its lab and chart
dictionaries).

FIXED VALUES — these must equal the original workflow's for the same
results; they are listed plainly, in the original order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES: lab series (48 h / 96 h, cases and controls)
# item id -> label; several ids fuse into one label.
LAB_LABELS: list[tuple[int, str]] = [
    (50868, "ANIONGAP"), (50862, "ALBUMIN"), (51144, "BANDS"), (50882, "BICARBONATE"),
    (50885, "BILIRUBIN"), (50912, "CREATININE"), (50806, "CHLORIDE"), (50902, "CHLORIDE"),
    (50809, "GLUCOSE"), (50931, "GLUCOSE"), (50810, "HEMATOCRIT"), (51221, "HEMATOCRIT"),
    (50811, "HEMOGLOBIN"), (51222, "HEMOGLOBIN"), (50813, "LACTATE"), (51265, "PLATELET"),
    (50822, "POTASSIUM"), (50971, "POTASSIUM"), (51275, "PTT"), (51237, "INR"),
    (51274, "PT"), (50824, "SODIUM"), (50983, "SODIUM"), (51006, "BUN"),
    (51300, "WBC"), (51301, "WBC"), (50924, "Ferritin"), (50998, "Transferrin"),
    (50910, "CreatineKinase"), (50911, "CK_MB"), (50915, "D_Dimer"), (50963, "NTproBNP"),
    (51288, "SedimentationRate"), (51214, "Fibrinogen"), (50954, "LDH"), (50960, "Magnesium"),
    (50808, "Calcium_free"), (50821, "pO2_bloodgas"), (50820, "pH_bloodgas"),
    (50818, "pCO2_bloodgas"), (50817, "SO2_bloodgas"), (51003, "Troponin_T"),
    (51014, "Glucose_CSF"), (51024, "Total_Protein_Joint_Fluid"), (51059, "Total_Protein_Pleural"),
    (51070, "Urine_Albumin_Creatinine_ratio"), (51128, "WBC_Ascites"),
]
# Items fetched by the series queries but never labelled (ALT, AST, ammonia).
LAB_UNLABELLED: list[int] = [50861, 50878, 50866]
# Plausibility limits of the series queries: (item id, lower, upper); a value
# below lower or above upper becomes NULL (the row is kept).
LAB_SERIES_BOUNDS: list[tuple[int, float | None, float | None]] = [
    (50862, None, 10), (50868, None, 10000), (51144, 0, 100), (50882, None, 10000),
    (50885, None, 150), (50806, None, 10000), (50902, None, 10000), (50912, None, 150),
    (50809, None, 10000), (50931, None, 10000), (50810, None, 100), (51221, None, 100),
    (50811, None, 50), (51222, None, 50), (50813, None, 50), (51265, None, 10000),
    (50822, None, 30), (50971, None, 30), (51275, None, 150), (51237, None, 50),
    (51274, None, 150), (50824, None, 200), (50983, None, 200), (51006, None, 300),
    (51300, None, 1000), (51301, None, 1000), (50861, None, 10000), (50878, None, 10000),
    (50866, None, 10000), (50924, None, 10000), (50998, None, 10000), (50910, None, 20000),
    (50911, None, 10000), (50915, None, 100000), (50963, None, 100000), (51288, None, 5000),
    (51214, None, 10000), (50954, None, 10000), (50960, None, 50), (50808, None, 50),
    (50821, None, 1000), (50820, None, 15), (50818, None, 500), (50817, None, 100),
    (51003, None, 100), (51014, None, 10000), (51024, None, 100), (51059, None, 100),
    (51070, None, 100000), (51128, None, 100000),
]
# Output columns of the lab series, in order.  (The original's first column
# tests the label 'ANION GAP' while the mapping emits 'ANIONGAP', so it is
# always NULL there; here one shared label list is used.)
LAB_COLUMNS: list[str] = [
    "ANIONGAP", "ALBUMIN", "BANDS", "BICARBONATE", "BILIRUBIN", "CREATININE", "CHLORIDE",
    "GLUCOSE", "HEMATOCRIT", "HEMOGLOBIN", "LACTATE", "PLATELET", "POTASSIUM", "PTT", "INR",
    "PT", "SODIUM", "BUN", "WBC", "Ferritin", "Transferrin", "CreatineKinase", "CK_MB",
    "D_Dimer", "NTproBNP", "SedimentationRate", "Fibrinogen", "LDH", "Magnesium",
    "Calcium_free", "pO2_bloodgas", "pH_bloodgas", "pCO2_bloodgas", "SO2_bloodgas",
    "Troponin_T", "Glucose_CSF", "Total_Protein_Joint_Fluid", "Total_Protein_Pleural",
    "Urine_Albumin_Creatinine_ratio", "WBC_Ascites",
]

# ---------------------------------------------------------------------------
# FIXED VALUES: long-form lab rows in the 48 h before suspicion of infection
HOURLY_LAB_ITEMS: list[int] = [
    50868, 50862, 51144, 50882, 50885, 50912, 50902, 50806, 50931, 50809, 51221, 50810,
    51222, 50811, 50813, 51265, 50971, 50822, 51275, 51237, 51274, 50983, 50824, 51006,
    51301, 51300,
]
HOURLY_LAB_LABELS: list[tuple[int, str]] = [
    (50868, "ANION GAP"), (50862, "ALBUMIN"), (50882, "BICARBONATE"), (50885, "BILIRUBIN"),
    (50912, "CREATININE"), (50806, "CHLORIDE"), (50902, "CHLORIDE"), (50809, "GLUCOSE"),
    (50931, "GLUCOSE"), (50810, "HEMATOCRIT"), (51221, "HEMATOCRIT"), (50811, "HEMOGLOBIN"),
    (51222, "HEMOGLOBIN"), (50813, "LACTATE"), (51265, "PLATELET"), (50822, "POTASSIUM"),
    (50971, "POTASSIUM"), (51275, "PTT"), (51237, "INR"), (51274, "PT"), (50824, "SODIUM"),
    (50983, "SODIUM"), (51006, "BUN"), (51300, "WBC"), (51301, "WBC"), (51144, "BANDS"),
]
HOURLY_LAB_BOUNDS: list[tuple[int, float | None, float | None]] = [
    (50862, None, 10), (50868, None, 10000), (50882, None, 10000), (50885, None, 150),
    (50806, None, 10000), (50902, None, 10000), (50912, None, 150), (50809, None, 10000),
    (50931, None, 10000), (50810, None, 100), (51221, None, 100), (50811, None, 50),
    (51222, None, 50), (50813, None, 50), (51265, None, 10000), (50822, None, 30),
    (50971, None, 30), (51275, None, 150), (51237, None, 50), (51274, None, 150),
    (50824, None, 200), (50983, None, 200), (51006, None, 300), (51300, None, 1000),
    (51301, None, 1000), (51144, 0, 100),
]

# ---------------------------------------------------------------------------
# FIXED VALUES: vital series — ordered range rules, first match wins.
# (item ids, lower, lower inclusive, upper, upper inclusive, measure id)
VITAL_RULES: list[tuple[tuple[int, ...], float | None, bool, float | None, bool, int]] = [
    ((220045,), 0, False, 300, False, 1),
    ((220179, 220050, 225309), 0, False, 400, False, 2),
    ((8368, 8440, 8441, 8555, 220180, 220051, 225310), 0, False, 300, False, 3),
    ((220052, 220181, 225312), 0, False, 300, False, 4),
    ((220210, 224690), 0, False, 70, False, 5),
    ((223761, 678), 70, False, 120, False, 6),
    ((223762, 676), 10, False, 50, False, 6),
    ((646, 220277), 0, False, 100, True, 7),
    ((807, 811, 1529, 3745, 3744, 225664, 220621, 226537), 0, False, None, False, 8),
    ((228369, 224842, 220088, 227543), 0, False, None, False, 10),
    ((228374, 227547), 0, False, None, False, 11),
    ((228375,), 0, True, None, False, 12),
    ((228376, 227546), None, False, None, False, 13),
    ((228380,), None, False, None, False, 14),
    ((228381,), None, False, None, False, 15),
    ((224684,), 0, False, None, False, 16),
    ((224685,), 0, False, None, False, 17),
    ((224686,), 0, False, None, False, 18),
    ((224691,), 0, True, None, False, 19),
    ((224695,), 0, True, None, False, 20),
    ((224700,), 0, True, None, False, 21),
    ((220218,), 0, False, None, False, 22),
    ((223834, 227582), 0, True, None, False, 23),
    ((223835,), 0, True, None, False, 24),
    ((227444,), 0, True, None, False, 25),
]
# Items actually fetched from the chart log (the IN-list).
VITAL_ITEMS: list[int] = [
    220045, 220179, 220050, 225309, 220180, 220051, 225310, 220052, 220181, 225312,
    220210, 224690, 220277, 225664, 220621, 226537, 223762, 223761, 228369, 224842,
    220088, 227543, 228374, 227547, 228375, 228376, 227546, 228380, 228381, 224684,
    224685, 224686, 224691, 224695, 224700, 220218, 223834, 227582, 223835, 227444,
]
# Fahrenheit items converted with (v - 32) / 1.8 after the range test.
VITAL_FAHRENHEIT: list[int] = [223761, 678]
# Output columns (measure id, name), in order; id 8 (glucose) is not projected.
VITAL_COLUMNS: list[tuple[int, str]] = [
    (2, "SysBP"), (3, "DiaBP"), (4, "MeanBP"), (5, "RespRate"), (1, "HeartRate"),
    (7, "SpO2_pulsoxy"), (6, "TempC"), (10, "CardiacOutput"), (11, "SV"), (12, "SVI"),
    (13, "SVV"), (14, "TFC"), (15, "TPR"), (16, "TVset"), (17, "TVobserved"),
    (18, "TVspontaneous"), (19, "Flowrate"), (20, "PeakInspPressure"), (21, "TotalPEEPLevel"),
    (22, "VitalCapacity"), (23, "O2Flow"), (24, "FiO2"), (25, "CRP"),
]

# ---------------------------------------------------------------------------
# FIXED VALUES: cohort rules
SEPSIS_ICD9_CODES: list[str] = ["78552", "99591", "99592"]
SURGICAL_SERVICES: list[str] = ["CSURG", "VSURG", "TSURG"]
SOURCE_SYSTEM = "metavision"
ETHNICITY_KEYWORDS: list[str] = ["WHITE", "BLACK", "ASIAN", "HISPANIC"]
ETHNICITY_DEFAULT = "OTHER"
AGE_TOPCODE_ABOVE = 89
AGE_TOPCODE_VALUE = 91.4
DAYS_PER_YEAR = 365.242
SECONDS_PER_YEAR = 31556908.8  # 60 * 60 * 24 * 365.242

# FIXED VALUES: per-subject lab panels (name, dictionary-label test, value column)
# 'like' = case-insensitive substring of the dictionary label, 'in' = exact label.
LAB_PANELS: list[tuple[str, str, str, str]] = [
    ("WBC", "like", "wbc", "valuenum"),
    ("creatinine", "like", "creatinine", "valuenum"),
    ("anion_gap", "in", "Anion Gap", "value"),
    ("sodium", "like", "sodium", "valuenum"),
    ("hemoglobin", "like", "hemoglobin", "valuenum"),
    ("lactate", "like", "lactate", "valuenum"),
    ("potassium", "like", "potassium", "valuenum"),
    ("urea_nitrogen", "like", "urea nitrogen", "valuenum"),
    ("glucose", "like", "glucose", "valuenum"),
]


# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class LabelSpec:
    """item -> label mapping with per-item bounds; measures are labels."""

    labels: list[tuple[int, str]]
    bounds: list[tuple[int, float | None, float | None]] = field(default_factory=list)
    columns: list[str] = field(default_factory=list)
    extra_items: list[int] = field(default_factory=list)

    @property
    def items(self) -> list[int]:
        seen: dict[int, None] = {}
        for i, _ in self.labels:
            seen.setdefault(i, None)
        for i in self.extra_items:
            seen.setdefault(i, None)
        return list(seen)


@dataclass(frozen=True)
class RuleSpec:
    """Ordered range rules -> measure id (first match wins), with unit conversion."""

    rules: list[tuple[tuple[int, ...], float | None, bool, float | None, bool, int]]
    items: list[int]
    columns: list[tuple[int, str]]
    fahrenheit: list[int] = field(default_factory=list)


def lab_series_spec() -> LabelSpec:
    return LabelSpec(LAB_LABELS, LAB_SERIES_BOUNDS, LAB_COLUMNS, LAB_UNLABELLED)


def hourly_lab_spec() -> LabelSpec:
    labelled = {i for i, _ in HOURLY_LAB_LABELS}
    return LabelSpec(HOURLY_LAB_LABELS, HOURLY_LAB_BOUNDS, [],
                     [i for i in HOURLY_LAB_ITEMS if i not in labelled])


def vital_series_spec() -> RuleSpec:
    return RuleSpec(VITAL_RULES, VITAL_ITEMS, VITAL_COLUMNS, VITAL_FAHRENHEIT)
