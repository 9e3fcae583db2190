"""Explicit schemas and code books for every layer.

Bronze is never inferred: a declared read schema keeps scans slim (nested
fields that are not listed are never materialised) and makes a missing
field a null instead of an analysis error.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

S = StringType()

DRUG_STRUCT = StructType(
    [
        StructField("medicinalproduct", S),
        StructField("drugcharacterization", S),
        StructField("drugindication", S),
    ]
)

REACTION_STRUCT = StructType([StructField("reactionmeddrapt", S)])

PATIENT_STRUCT = StructType(
    [
        StructField("patientsex", S),
        StructField("patientonsetage", S),
        StructField("patientonsetageunit", S),
        StructField("drug", ArrayType(DRUG_STRUCT)),
        StructField("reaction", ArrayType(REACTION_STRUCT)),
    ]
)

BRONZE_REPORT = StructType(
    [
        StructField("safetyreportid", S),
        StructField("receivedate", S),
        StructField("serious", S),
        StructField("seriousnessdeath", S),
        StructField("seriousnesshospitalization", S),
        StructField("primarysourcecountry", S),
        StructField("patient", PATIENT_STRUCT),
    ]
)

# One API page body: {"results": [report, ...]}
PAGE_BODY = StructType([StructField("results", ArrayType(BRONZE_REPORT))])

SILVER_EVENTS = StructType(
    [
        StructField("safety_report_id", S),
        StructField("country", S),
        StructField("report_date", DateType()),
        StructField("is_serious", IntegerType()),
        StructField("death", IntegerType()),
        StructField("hospitalization", IntegerType()),
        StructField("patient_sex", S),
        StructField("patient_age", IntegerType()),
    ]
)

SILVER_DRUGS = StructType(
    [
        StructField("safety_report_id", S),
        StructField("drug_name", S),
        StructField("indication", S),
        StructField("drug_role", S),
    ]
)

SILVER_REACTIONS = StructType(
    [
        StructField("safety_report_id", S),
        StructField("reaction_name", S),
    ]
)

SILVER = {
    "adverse_events": SILVER_EVENTS,
    "drugs": SILVER_DRUGS,
    "reactions": SILVER_REACTIONS,
}

_COUNTS = [
    StructField("total_reports", LongType()),
    StructField("serious_reports", LongType()),
    StructField("death_reports", LongType()),
    StructField("hospitalization_reports", LongType()),
    StructField("seriousness_rate_pct", DoubleType()),
]

GOLD = {
    "safety_overview": StructType(list(_COUNTS)),
    "monthly_trends": StructType(
        [StructField("year", IntegerType()), StructField("month", IntegerType())] + list(_COUNTS)
    ),
    "drug_summary": StructType(
        [
            StructField("drug_name", S),
            StructField("total_reports", LongType()),
            StructField("serious_reports", LongType()),
            StructField("seriousness_rate_pct", DoubleType()),
        ]
    ),
    "reaction_summary": StructType(
        [
            StructField("reaction_name", S),
            StructField("total_reports", LongType()),
            StructField("serious_reports", LongType()),
            StructField("seriousness_rate_pct", DoubleType()),
        ]
    ),
    "drug_reaction_pairs": StructType(
        [
            StructField("drug_name", S),
            StructField("reaction_name", S),
            StructField("pair_count", LongType()),
            StructField("serious_count", LongType()),
            StructField("seriousness_rate_pct", DoubleType()),
        ]
    ),
    "ml_features": StructType(
        [
            StructField("safety_report_id", S),
            StructField("report_date", DateType()),
            StructField("country", S),
            StructField("patient_sex", S),
            StructField("patient_age", IntegerType()),
            StructField("is_serious", IntegerType()),
            StructField("num_drugs", LongType()),
            StructField("has_suspect_drug", IntegerType()),
            StructField("num_reactions", LongType()),
        ]
    ),
}

MODEL_RUNS = StructType(
    [
        StructField("run_id", S),
        StructField("run_name", S),
        StructField("status", S),
        StructField("start_time", TimestampType()),
        StructField("params", MapType(S, S)),
        StructField("metrics", MapType(S, DoubleType())),
    ]
)

# ---------------------------------------------------------------------------
# Code books of the safety-report format. These must equal the
# source system's codes for results to be right.
# ---------------------------------------------------------------------------

# serious / seriousnessdeath / seriousnesshospitalization: "1" yes, "2" no
FLAG_YES = 1
FLAG_NO = 2

# patient.patientsex
SEX_LABELS = {"0": "Unknown", "1": "Male", "2": "Female"}

# patient.drug[].drugcharacterization
DRUG_ROLE_LABELS = {"1": "Suspect", "2": "Concomitant", "3": "Interacting"}

# patient.patientonsetageunit -> factor that turns the age into years
# 800 decade, 801 year, 802 month, 803 week, 804 day, 805 hour
AGE_UNIT_TO_YEARS = {
    "800": ("mul", 10.0),
    "801": ("mul", 1.0),
    "802": ("div", 12.0),
    "803": ("div", 52.1429),
    "804": ("div", 365.25),
    "805": ("div", 8766.0),
}
MIN_AGE_YEARS = 0
MAX_AGE_YEARS = 120

# notebook label for the raw `serious` code
SERIOUS_LABELS = {"1": "Serious", "2": "Not Serious"}

# quality gate thresholds
MAX_NULL_RATE = 0.05
MIN_ROW_COUNT = 10

# model settings
RANDOM_STATE = 42
TEST_SIZE = 0.2
FEATURE_COLS = [
    "patient_age",
    "patient_sex",
    "country",
    "num_drugs",
    "num_reactions",
    "has_suspect_drug",
]
TARGET_COL = "is_serious"

REQUIRED_COLUMNS = {
    "adverse_events": [
        "safety_report_id",
        "report_date",
        "is_serious",
        "country",
        "patient_sex",
        "patient_age",
    ],
    "drugs": ["safety_report_id", "drug_name", "drug_role"],
    "reactions": ["safety_report_id", "reaction_name"],
}
