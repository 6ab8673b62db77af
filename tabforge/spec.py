"""Configuration as plain dataclasses (no YAML parser).

Fixed values below must stay equal to the reference's configuration for the
patient-record preset to behave the same: thresholds, alias maps, ranges.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference configuration)
# ---------------------------------------------------------------------------
IMBALANCE_THRESHOLD = 0.20
SKEW_THRESHOLD = 1.0
IQR_MULTIPLIER = 1.5
TEST_SIZE = 0.2
RANDOM_STATE = 42
TOP_K_FEATURES = 10
CV_FOLDS = 5
CONFIDENCE_THRESHOLD = 0.50
OVERFIT_GAP = 0.10
UNDERFIT_LEVEL = 0.80
#: Texts of the fit diagnosis; {gap} is the train accuracy less the test accuracy, to 4 places.
DIAGNOSIS_TEXTS = {
    "overfit": "OVERFIT — train/test gap: {gap}",
    "underfit": f"UNDERFIT — both scores below {UNDERFIT_LEVEL}",
    "good": "GOOD FIT — train/test gap: {gap}",
}
DRIFT_SHARE = 0.5
MIN_LIVE_ROWS = 30
SMOTE_NEIGHBOURS = 5
LOW_CONFIDENCE_WARNING = "Low confidence — additional clinical review recommended"

PATIENT_COLUMNS = [
    "age", "race", "marital_status", "t_stage", "n_stage", "sixth_stage", "differentiate", "grade",
    "a_stage", "tumor_size", "estrogen_status", "progesterone_status", "regional_node_examined",
    "regional_node_positive", "survival_months", "status",
]
PATIENT_NUMERIC = ["age", "tumor_size", "regional_node_examined", "regional_node_positive", "survival_months"]
PATIENT_CATEGORICAL = [
    "race", "marital_status", "t_stage", "n_stage", "sixth_stage", "differentiate", "grade", "a_stage",
    "estrogen_status", "progesterone_status", "status",
]
PATIENT_OUTLIER_COLS = ["tumor_size", "regional_node_examined", "regional_node_positive"]
PATIENT_SKEWED_COLS = ["tumor_size", "regional_node_positive"]
PATIENT_DROP_COLS = ["survival_months"]
PATIENT_TARGET_MAPPING = {"Alive": 1, "Dead": 0}

RACE_MAP = {"white": "White", "black": "Black", "african american": "Black", "other": "Other"}
MARITAL_MAP = {
    "married": "Married", "single": "Single", "unmarried": "Single", "divorced": "Divorced",
    "widowed": "Widowed", "widow": "Widowed", "separated": "Separated",
}
DIFFERENTIATE_MAP = {
    "well differentiated": "Well differentiated", "well": "Well differentiated",
    "moderately differentiated": "Moderately differentiated", "moderate": "Moderately differentiated",
    "moderately": "Moderately differentiated", "poorly differentiated": "Poorly differentiated",
    "poorly": "Poorly differentiated", "undifferentiated": "Undifferentiated",
}
ASTAGE_MAP = {"regional": "Regional", "distant": "Distant", "metastatic": "Distant"}
# "yes"/"no" are kept as strings here (the reference's YAML loader turns them into booleans).
STATUS_MAP = {
    "positive": "Positive", "pos": "Positive", "yes": "Positive", "+": "Positive",
    "negative": "Negative", "neg": "Negative", "no": "Negative", "-": "Negative",
}
PATIENT_RANGES = {
    "age": (1, 120), "tumor_size": (0, 200), "regional_node_examined": (0, 100), "regional_node_positive": (0, 100),
}
# ---------------------------------------------------------------------------


@dataclass
class QualitySpec:
    """What the validation suite (L2) checks."""

    expected_columns: list[str]
    numeric_cols: list[str]
    categorical_cols: list[str]
    target: str
    outlier_cols: list[str]
    leakage_cols: list[str] = field(default_factory=list)
    imbalance_threshold: float = IMBALANCE_THRESHOLD
    skew_threshold: float = SKEW_THRESHOLD
    iqr_multiplier: float = IQR_MULTIPLIER
    # "exact" (ranks over distinct values) or "approx" (bounded memory, rank error ~ n/accuracy)
    quantile_method: str = "exact"


@dataclass
class ScoringSpec:
    """Normalization and validation rules for records to score."""

    numeric_fields: list[str]
    alias_maps: dict[str, dict[str, str]]
    ranges: dict[str, tuple[float, float]]
    cross_field: list[tuple[str, str]] = field(default_factory=list)  # (a, b): a <= b
    # categories without aliases: the values the model was fitted on; others, and null, are rejected
    categories: dict[str, list[str]] = field(default_factory=dict)
    confidence_threshold: float = CONFIDENCE_THRESHOLD
    class_names: dict[int, str] = field(default_factory=lambda: {0: "Dead", 1: "Alive"})
    warning_text: str = LOW_CONFIDENCE_WARNING


PATIENT_SCORING = ScoringSpec(
    numeric_fields=["age", "tumor_size", "regional_node_examined", "regional_node_positive"],
    alias_maps={
        "race": RACE_MAP, "marital_status": MARITAL_MAP, "differentiate": DIFFERENTIATE_MAP,
        "a_stage": ASTAGE_MAP, "estrogen_status": STATUS_MAP, "progesterone_status": STATUS_MAP,
    },
    ranges=dict(PATIENT_RANGES),
    cross_field=[("regional_node_positive", "regional_node_examined")],
)

PATIENT_QUALITY = QualitySpec(
    expected_columns=list(PATIENT_COLUMNS),
    numeric_cols=list(PATIENT_NUMERIC),
    categorical_cols=list(PATIENT_CATEGORICAL),
    target="status",
    outlier_cols=list(PATIENT_OUTLIER_COLS),
    leakage_cols=["survival_months"],
)


@dataclass
class TrainSpec:
    """Feature preparation and model training."""

    features: list[str]
    categorical: list[str]
    target: str
    id_col: str
    outlier_cols: list[str] = field(default_factory=list)
    skewed_cols: list[str] = field(default_factory=list)
    drop_cols: list[str] = field(default_factory=list)
    top_k: int = TOP_K_FEATURES
    test_size: float = TEST_SIZE
    seed: int = RANDOM_STATE
    cv_folds: int = CV_FOLDS
    smote_k: int = SMOTE_NEIGHBOURS
    rebalance: bool = True
    # True: rebalance and feature scores are fitted on the training split only (recommended).
    # False: the reference order (rebalance and select on all rows, then split).
    resample_after_split: bool = True
    models: tuple[str, ...] = ("random_forest", "gbt")
    outlier_mode: str = "sequential"
    quantile_method: str = "exact"
