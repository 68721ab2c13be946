"""Feature specification: the fixed values every stage shares.

Everything in this module is data, not logic. The values below must equal
the reference's for results to match, so they are kept together, in their
natural order, as plain text.
"""

from __future__ import annotations

import math

INF = math.inf

# ---------------------------------------------------------------------------
# Column names and feature groups
# ---------------------------------------------------------------------------

TARGET = "loan_approved"
KEY = "application_id"
TS = "application_ts"

RAW_NUMERIC = [
    "age",
    "income",
    "employment_length",
    "credit_score",
    "debt_to_income",
    "loan_amount",
]
RAW_CATEGORICAL = ["home_ownership", "loan_purpose"]
RAW_COLUMNS = RAW_NUMERIC + RAW_CATEGORICAL

RATIO_FEATURES = ["loan_to_income_ratio", "credit_score_to_age_ratio"]
BUCKET_FEATURES = ["age_category", "income_category", "credit_category"]
FLAG_FEATURES = [
    "high_income",
    "excellent_credit",
    "low_debt_ratio",
    "experienced_employment",
]

NUMERICAL_FEATURES = RAW_NUMERIC + RATIO_FEATURES
CATEGORICAL_FEATURES = RAW_CATEGORICAL + BUCKET_FEATURES
BOOLEAN_FEATURES = FLAG_FEATURES

# Model order: raw column order, then creation order.
ALL_FEATURES = RAW_COLUMNS + RATIO_FEATURES + BUCKET_FEATURES + FLAG_FEATURES

UNKNOWN = "unknown"

# ---------------------------------------------------------------------------
# Ratio features (name, numerator, denominator)
# ---------------------------------------------------------------------------

RATIOS = [
    ("loan_to_income_ratio", "loan_amount", "income"),
    ("credit_score_to_age_ratio", "credit_score", "age"),
]

# ---------------------------------------------------------------------------
# Right-closed buckets (name, source, edges, labels);
# the lowest edge is included.
# ---------------------------------------------------------------------------

BUCKETS = [
    ("age_category", "age", [0, 25, 35, 45, 55, 100],
     ["young", "adult", "middle_age", "mature", "senior"]),
    ("income_category", "income", [0, 30000, 50000, 80000, INF],
     ["low", "medium", "high", "very_high"]),
    ("credit_category", "credit_score", [0, 550, 650, 750, INF],
     ["poor", "fair", "good", "excellent"]),
]

# ---------------------------------------------------------------------------
# Threshold flags (name, source, operator, threshold)
# ---------------------------------------------------------------------------

FLAGS = [
    ("high_income", "income", ">=", 75000),
    ("excellent_credit", "credit_score", ">=", 750),
    ("low_debt_ratio", "debt_to_income", "<=", 0.3),
    ("experienced_employment", "employment_length", ">=", 5),
]

# ---------------------------------------------------------------------------
# Scorecard point tables, evaluated top-down; a comparison
# with a missing value is false, so missing falls to the last branch.
# (source, operator, [(threshold, points), ...], otherwise)
# ---------------------------------------------------------------------------

SCORECARD = [
    ("credit_score", ">=", [(750, 40), (650, 20), (550, 5)], -20),
    ("income", ">=", [(80000, 25), (50000, 15), (30000, 5)], -10),
    ("debt_to_income", "<=", [(0.2, 20), (0.4, 10), (0.6, -5)], -20),
    ("employment_length", ">=", [(5, 15), (2, 10), (1, 5)], -5),
]
OWNERSHIP_POINTS = [("OWN", 15), ("MORTGAGE", 10)]
# loan_amount / income: <=0.3 -> 10, <=0.5 -> 5, >1.0 -> -15, else 0
LOAN_TO_INCOME_POINTS = [(0.3, 10), (0.5, 5)]
LOAN_TO_INCOME_HIGH = (1.0, -15)
APPROVAL_CUTOFF = 50

# ---------------------------------------------------------------------------
# Clip ranges and rounding digits of the raw generator
# ---------------------------------------------------------------------------

CLIP_RANGES = [
    ("age", 18, 80),
    ("income", 20000, 500000),
    ("employment_length", 0, 40),
    ("credit_score", 300, 850),
    ("debt_to_income", 0, 0.8),
    ("loan_amount", 5000, 200000),
]
ROUND_DIGITS = [
    ("age", 0),
    ("income", 0),
    ("employment_length", 1),
    ("credit_score", 0),
    ("debt_to_income", 3),
    ("loan_amount", 0),
]

# ---------------------------------------------------------------------------
# Confidence band on P(class 1)
# ---------------------------------------------------------------------------

CONFIDENCE_BANDS = [(0.8, "high"), (0.6, "medium")]
CONFIDENCE_OTHERWISE = "low"

# ---------------------------------------------------------------------------
# Quality-gate thresholds
# ---------------------------------------------------------------------------

PERFORMANCE_THRESHOLDS = [
    ("val_accuracy", 0.80, "accuracy"),
    ("val_precision", 0.75, "precision"),
    ("val_recall", 0.75, "recall"),
    ("val_f1", 0.75, "f1_score"),
    ("val_auc", 0.75, "auc"),
]
MIN_TEST_ROWS = 1000
MAX_COLUMN_MISSING_PCT = 50
MAX_OVERALL_MISSING_PCT = 10
MIN_CLASS_SHARE = 0.1
DISTINCT_REPORT_BELOW = 20

# ---------------------------------------------------------------------------
# Split and model defaults
# ---------------------------------------------------------------------------

TEST_SIZE = 0.2
SEED = 42
RF_TREES = 100
RF_DEPTH = 10
LR_MAX_ITER = 1000
