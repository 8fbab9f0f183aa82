"""Settings of the churn domain: column lists, value lists, cut points, rules.

Operators take these as arguments; this module only holds the defaults.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Column names, accepted values, bounds and labels that results
# are compared on.

RAW_COLUMNS = [
    "customerID", "gender", "SeniorCitizen", "Partner", "Dependents", "tenure",
    "PhoneService", "MultipleLines", "InternetService", "OnlineSecurity",
    "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV",
    "StreamingMovies", "Contract", "PaperlessBilling", "PaymentMethod",
    "MonthlyCharges", "TotalCharges", "Churn",
]

INTERNET_ADDONS = [
    "online_security", "online_backup", "device_protection",
    "tech_support", "streaming_tv", "streaming_movies",
]
ADDON_SERVICES = INTERNET_ADDONS + ["multiple_lines"]
ALL_SERVICES = ["phone_service"] + ADDON_SERVICES
SUPPORT_SERVICES = ["tech_support", "online_security", "device_protection"]

# column -> {placeholder value: value it stands for}
PLACEHOLDERS = {
    **{c: {"No internet service": "No"} for c in INTERNET_ADDONS},
    "multiple_lines": {"No phone service": "No"},
}

YES_NO = ["Yes", "No"]
GENDERS = ["Male", "Female"]
INTERNET_KINDS = ["DSL", "Fiber optic", "No"]
CONTRACTS = ["Month-to-month", "One year", "Two year"]
PAYMENT_METHODS = [
    "Electronic check", "Mailed check",
    "Bank transfer (automatic)", "Credit card (automatic)",
]
CONTRACT_RISK = {"Month-to-month": 3, "One year": 2, "Two year": 1}

# (inclusive upper bound in months, label); the last label has no bound
TENURE_BANDS = [(6, "New"), (12, "Growing"), (24, "Established"), (48, "Loyal"), (None, "Champion")]
TENURE_LABELS = [label for _, label in TENURE_BANDS]
CHARGE_TIERS = ["Low", "Mid", "High", "Premium"]
CHARGE_QUANTILES = [0.25, 0.50, 0.75]
LIVE_CHARGE_CUTS = [35.0, 65.0, 89.0]

RISK_CATEGORIES = ["Critical", "High", "Medium", "Low"]
# (inclusive lower bound of the probability, tier)
PROBABILITY_TIERS = [(0.70, "Critical"), (0.50, "High"), (0.30, "Medium"), (None, "Low")]

# display name -> (column, comparison, value)
SERVICE_FLAGS = {
    "Phone service": ("has_phone", "phone_service", "==", "Yes"),
    "Multiple lines": ("has_multi_lines", "multiple_lines", "==", "Yes"),
    "Internet (any)": ("has_internet", "internet_service", "!=", "No"),
    "Fiber optic": ("has_fiber", "internet_service", "==", "Fiber optic"),
    "Online security": ("has_security", "online_security", "==", "Yes"),
    "Online backup": ("has_backup", "online_backup", "==", "Yes"),
    "Device protection": ("has_device_protect", "device_protection", "==", "Yes"),
    "Tech support": ("has_tech_support", "tech_support", "==", "Yes"),
    "Streaming TV": ("has_streaming_tv", "streaming_tv", "==", "Yes"),
    "Streaming movies": ("has_streaming_movies", "streaming_movies", "==", "Yes"),
}

NUMERIC_FEATURES = [
    "tenure", "monthly_charges", "total_charges", "num_services",
    "avg_monthly_spend", "contract_risk_score", "support_score",
]
CATEGORICAL_FEATURES = [
    "gender", "senior_citizen", "partner", "dependents", "phone_service",
    "multiple_lines", "internet_service", "online_security", "online_backup",
    "device_protection", "tech_support", "streaming_tv", "streaming_movies",
    "contract", "paperless_billing", "payment_method", "tenure_segment",
    "monthly_charges_tier",
]
FEATURES = NUMERIC_FEATURES + CATEGORICAL_FEATURES
LABEL = "churn_flag"
KEY = "customer_id"

SEGMENTS = ["Champions", "At Risk", "Needs Attention", "Promising", "Sleepers", "Lost Cause"]
SEED = 42
TEST_FRACTION = 0.2
FOLDS = 5
SAMPLE_SIZE = 1000
MIN_ROC_AUC = 0.75
MODEL_VERSION = "1.0.0"

# End of the fixed values.

# Texts name the rule that applies; another mapping can be passed.
RISK_ACTIONS = {
    "m2m_first_months": "Monthly contract, tenure 0 to 6",
    "m2m_first_year": "Monthly contract, tenure 7 to 12",
    "m2m_fiber": "Monthly contract after 12 months, fiber",
    "m2m_high_bill": "Monthly contract after 12 months, charge above 89",
    "m2m_other": "Monthly contract after 12 months",
    "few_services": "Term contract, no support and at most 2 services",
    "steady": "Term contract, other",
}
SCORE_ACTIONS = {
    "low_risk": "Score below 30%",
    "m2m_first_months": "Monthly contract, tenure 0 to 6",
    "m2m_first_year": "Monthly contract, tenure 7 to 12",
    "m2m_fiber_high_bill": "Monthly contract after 12 months, fiber, charge above 75",
    "m2m_other": "Monthly contract after 12 months",
    "no_support": "Term contract without support",
    "few_services": "Term contract, at most 2 services",
    "watch": "No other rule applies, score {pct}%",
}
SEGMENT_NOTES = {
    "Champions": "high value, low risk",
    "At Risk": "high value, high risk",
    "Needs Attention": "high value, medium risk",
    "Promising": "low value, medium risk",
    "Sleepers": "low value, low risk",
    "Lost Cause": "low value, high risk",
}

RAW_SCHEMA = T.StructType(
    [
        T.StructField(
            name,
            {"SeniorCitizen": T.IntegerType(), "tenure": T.IntegerType(), "MonthlyCharges": T.DoubleType()}.get(
                name, T.StringType()
            ),
        )
        for name in RAW_COLUMNS
    ]
)

_FEATURE_TYPES = {
    "tenure": T.IntegerType(),
    "monthly_charges": T.DoubleType(),
    "total_charges": T.DoubleType(),
    "num_services": T.IntegerType(),
    "avg_monthly_spend": T.DoubleType(),
    "contract_risk_score": T.IntegerType(),
    "support_score": T.IntegerType(),
}
REQUEST_SCHEMA = T.StructType(
    [T.StructField(KEY, T.StringType())]
    + [T.StructField(c, _FEATURE_TYPES.get(c, T.StringType())) for c in FEATURES]
)

# Bounds and accepted values.
# field -> ("range", low, high) with None for an open end, or ("one_of", values)
REQUEST_RULES = {
    "tenure": ("range", 0, 72),
    "monthly_charges": ("range", 0, 200),
    "total_charges": ("range", 0, None),
    "num_services": ("range", 0, 7),
    "avg_monthly_spend": ("range", 0, None),
    "contract_risk_score": ("one_of", [1, 2, 3]),
    "support_score": ("range", 0, 3),
    "gender": ("one_of", GENDERS),
    "internet_service": ("one_of", INTERNET_KINDS),
    "contract": ("one_of", CONTRACTS),
    "payment_method": ("one_of", PAYMENT_METHODS),
    "tenure_segment": ("one_of", TENURE_LABELS),
    "monthly_charges_tier": ("one_of", CHARGE_TIERS),
    **{
        c: ("one_of", YES_NO)
        for c in ["senior_citizen", "partner", "dependents", "phone_service", "multiple_lines",
                  *INTERNET_ADDONS, "paperless_billing"]
    },
}

# model -> [(column, rule, accepted values or None)]
_CONTRACT_RULES = [("contract", "accepted_values", CONTRACTS)]
_FLAG_RULES = [("churn_flag", "not_null", None), ("churn_flag", "accepted_values", [0, 1])]
_KEY_RULES = [("customer_id", "unique", None), ("customer_id", "not_null", None)]
DATA_RULES = {
    "customers": _KEY_RULES + _FLAG_RULES + [
        ("tenure", "not_null", None),
        ("monthly_charges", "not_null", None),
    ] + _CONTRACT_RULES + [("internet_service", "accepted_values", INTERNET_KINDS)],
    "stg_customers": _KEY_RULES + _FLAG_RULES + [
        ("tenure", "not_null", None),
        ("monthly_charges", "not_null", None),
        ("total_charges", "not_null", None),
    ] + _CONTRACT_RULES + [
        ("tenure_segment", "accepted_values", TENURE_LABELS),
        ("contract_risk_score", "accepted_values", [1, 2, 3]),
    ],
    "mart_churn_kpis": [("total_customers", "not_null", None), ("churn_rate_pct", "not_null", None)],
    "mart_churn_by_segment": [
        ("dimension", "not_null", None),
        ("dimension_value", "not_null", None),
        ("churn_rate_pct", "not_null", None),
    ],
    "mart_customer_risk": _KEY_RULES + [
        ("risk_score", "not_null", None),
        ("risk_category", "accepted_values", RISK_CATEGORIES),
        ("recommended_action", "not_null", None),
    ],
}
