"""Default settings of the reference job (only settings it actually reads).

Fixed values: these must equal the reference's defaults for equal results.
"""

# --- fixed values: column roles of the reference table -------------------
NUMERICAL_COLS = ["age", "trestbps", "chol", "thalach", "oldpeak"]
CATEGORICAL_COLS = ["sex", "cp", "fbs", "restecg", "exang", "slope", "ca", "thal"]
TARGET_COL = "target"
RAW_COLUMNS = ["age", "sex", "cp", "trestbps", "chol", "fbs", "restecg", "thalach",
               "exang", "oldpeak", "slope", "ca", "thal", "target"]
FEATURE_COLS = RAW_COLUMNS[:-1]
RENAMES = {"thalch": "thalach", "num": "target"}
DROP_IF_PRESENT = ["id", "dataset"]

# --- fixed values: sentinels (value -> null) ------------------------------
SENTINELS = {"ca": 4, "thal": 0, "chol": 0, "trestbps": 0}

# --- fixed values: bins, [lo, hi) with labels ------------------------------
BINS = {
    "age": ([0, 40, 50, 60, 70, 100], ["<40", "40-50", "50-60", "60-70", "70+"], "age_bin"),
    "chol": ([0, 200, 240, 600], ["normal", "borderline", "high"], "chol_bin"),
    "trestbps": ([0, 120, 140, 300], ["normal", "prehyper", "hyper"], "trestbps_bin"),
    "thalach": ([0, 100, 140, 220], ["low", "medium", "high"], "thalach_bin"),
    "oldpeak": ([-1, 0, 1, 2, 6], ["zero", "mild", "moderate", "severe"], "oldpeak_bin"),
}

# --- fixed values: transaction items (column -> prefix, in order) ----------
ITEM_COLUMNS = {"age_bin": "age", "chol_bin": "chol", "trestbps_bin": "bp", "thalach_bin": "hr",
                "oldpeak_bin": "dp", "cp": "cp", "sex": "sex", "fbs": "fbs", "exang": "exang",
                "slope": "slope", "ca": "ca", "thal": "thal"}
TARGET_ITEMS = {0: "no_disease", 1: "disease"}
TARGET_ITEM_OTHER = "unknown"

# --- fixed values: settings -------------------------------------------------
SEED = 42
TEST_SIZE = 0.2
PREPROCESSING = {"scaling_method": "standard", "handle_missing": "median",
                 "outlier_method": "iqr", "outlier_threshold": 1.5}
ASSOCIATION = {"min_support": 0.1, "min_confidence": 0.6, "min_lift": 1.2, "max_len": 4}
CLUSTERING = {"k_range": [2, 3, 4, 5, 6, 7], "best_k": 3, "n_init": 10, "linkage": "ward",
              "dbscan_eps": 0.5, "dbscan_min_samples": 5}
CLASSIFICATION = {"cv_folds": 5}
REGRESSION_TARGET = "trestbps"
SEMI = {"label_ratios": [0.05, 0.10, 0.20, 0.30], "threshold": 0.85, "max_iter": 10,
        "spreading_alpha": 0.2, "rbf_gamma": 20.0}
RISK_TIERS = ["low", "medium", "high"]
