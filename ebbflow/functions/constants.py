"""Domain constants.

FIXED VALUES — these must equal the behaviour being reproduced, so they
are stated plainly here, in natural order, and used everywhere else by
name.
"""

from __future__ import annotations

# ---------------------------------------------------------------- FIXED VALUES
LABEL = "churned"

RAW_COLUMNS = [
    "account_id", "gender", "seniorcitizen", "partner", "dependents",
    "months_with_provider", "phone_service", "extra_lines", "internet_plan",
    "addon_security", "addon_backup", "addon_device_protect",
    "addon_techsupport", "stream_tv", "stream_movies", "contract_type",
    "paperless_billing", "payment_method", "monthly_fee", "lifetime_spend",
    "churned", "customer_hash", "marketing_opt_in",
]

# Exact, case-sensitive misspellings repaired to "Fiber optic".
INTERNET_PLAN_FIXES = {
    "Fiber optiic": "Fiber optic",
    "Fiber opttic": "Fiber optic",
    "iFber optic": "Fiber optic",
    "FFiber optic": "Fiber optic",
    "Fiiber optic": "Fiber optic",
    "Fibe optic": "Fiber optic",
}

# Applied after lower-casing and stripping; unmatched values pass through.
PAYMENT_CODES = {
    "electronic check": "electronic_check",
    "mailed check": "mailed_check",
    "bank transfer (automatic)": "bank_transfer",
    "credit card (automatic)": "credit_card",
    "mailed_check": "mailed_check",
    "electronic_check": "electronic_check",
}
PAYMENT_NULL_TEXT = "nan"
PAYMENT_FALLBACK = "electronic_check"
HIGH_RISK_PAYMENT = "electronic_check"

# Tokens the CSV reader turns into nulls (note: upper-case "NAN" is not one).
CSV_NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Right-closed tenure bins (-1, 12], (12, 24], (24, 48], (48, 100];
# anything else (null, out of range) becomes the text "nan".
TENURE_EDGES = [-1.0, 12.0, 24.0, 48.0, 100.0]
TENURE_LABELS = ["0-12", "13-24", "25-48", "49+"]
TENURE_MISSING = "nan"

HIGH_VALUE_FEE = 70.35

DROP_COLUMNS = ["account_id", "customer_hash", "lifetime_spend", "marketing_opt_in"]

# value that maps to 1; anything else (other text, null) maps to 0
BINARY_POSITIVE = {
    "gender": "Male",
    "partner": "Yes",
    "dependents": "Yes",
    "phone_service": "Yes",
    "paperless_billing": "Yes",
}

CONTRACT_CODES = {"Two year": 0, "One year": 1, "Month-to-month": 2}
CONTRACT_DEFAULT = 1

ONEHOT_COLUMNS = [
    "internet_plan", "extra_lines", "payment_method",
    "addon_security", "addon_backup", "addon_device_protect",
    "addon_techsupport", "stream_tv", "stream_movies", "tenure_group",
]

# Threshold grid: 0.1 + i * step for i in 0..15, where step is the float
# spacing numpy's arange(0.1, 0.9, 0.05) produces.
THRESHOLD_START = 0.1
THRESHOLD_STEP = 0.05000000000000002
THRESHOLD_COUNT = 16
THRESHOLD_DEFAULT = 0.5

# Confidence segments, left-closed: name, range text, lower, upper.
CONFIDENCE_SEGMENTS = [
    ("very_low", "0.0-0.2", None, 0.2),
    ("low", "0.2-0.4", 0.2, 0.4),
    ("medium", "0.4-0.6", 0.4, 0.6),
    ("high", "0.6-0.8", 0.6, 0.8),
    ("very_high", "0.8-1.0", 0.8, None),
]

QUALITY_GATES = {"roc_auc_min": 0.85, "pr_auc_min": 0.65, "brier_max": 0.15}

# Positive-class weight used by the boosted-tree model.
GBT_POSITIVE_WEIGHT = 2.76

# EDA: churn-by-feature skips these; "key features" report keeps these.
CHURN_BY_FEATURE_SKIP = ["churned", "account_id", "customer_hash"]
KEY_FEATURES = ["contract_type", "internet_plan", "payment_method", "seniorcitizen"]
HISTOGRAM_BINS = 30
STRONG_CORRELATION = 0.5
IQR_FACTOR = 1.5
TOP_CATEGORIES = 10

# Monitoring limits: retrain when ROC-AUC drops by more than 0.05, any
# PSI exceeds 0.2, or the churn rate moves by more than 5 points.
PSI_ALERT = 0.2
AUC_DROP_ALERT = 0.05
CHURN_DRIFT_ALERT = 0.05

SEED = 42
TEST_SIZE = 0.2
N_FOLDS = 5
CAP_PER_CLASS = 100
# ------------------------------------------------------------ END FIXED VALUES


def threshold_grid() -> list[float]:
    return [THRESHOLD_START + i * THRESHOLD_STEP for i in range(THRESHOLD_COUNT)]
