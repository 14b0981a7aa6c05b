"""Fixed values.

Everything in this module must equal the values of the original
text-priority project for results to match: lexicons, category priors,
quantiles, class names, quality gate, histogram bounds and limits.  They are
listed plainly, in their natural order.  All of them are *defaults*: every
operator takes them as parameters, so another lexicon or gate is a call
argument, not a code change.
"""

from __future__ import annotations

# ---------------------------------------------------------------- fixed values
# Lexicon terms that push a text towards higher urgency.
URGENT_TERMS: tuple[str, ...] = (
    "acute",
    "severe",
    "malignant",
    "metastatic",
    "emergency",
    "hemorrhage",
    "sepsis",
    "shock",
    "infarction",
    "rupture",
    "obstruction",
    "failure",
    "fatal",
    "critical",
    "carcinoma",
)

# Lexicon terms that push a text towards lower urgency.
NORMAL_TERMS: tuple[str, ...] = (
    "chronic",
    "benign",
    "mild",
    "routine",
    "stable",
    "follow-up",
    "screening",
    "elective",
    "remission",
    "asymptomatic",
    "well-controlled",
)

# Category dimension of the clinical corpus: (key, name, prior).
CLINICAL_CATEGORIES: tuple[tuple[int, str, float], ...] = (
    (1, "neoplasms", 0.15),
    (2, "digestive system diseases", 0.00),
    (3, "nervous system diseases", 0.05),
    (4, "cardiovascular diseases", 0.15),
    (5, "general pathological conditions", -0.05),
)

# Quantiles of the train scores that cut the three classes.
LOW_QUANTILE = 0.35
HIGH_QUANTILE = 0.75

# Class names, and their alphabetical order used by every report.
VALID_LABELS: tuple[str, ...] = ("normal", "atencao", "urgente")
LABELS_SORTED: tuple[str, ...] = ("atencao", "normal", "urgente")
URGENT_LABEL = "urgente"

# Display name per class.
DISPLAY_NAMES: dict[str, str] = {
    "normal": "Normal",
    "atencao": "Atenção",
    "urgente": "Urgente",
}

# Quality gate.
GATE_MACRO_F1_MIN = 0.55
GATE_RECALL_URGENT_MIN = 0.70

# Cross-backend agreement floor (percent) and relative p50 reduction floor.
EQUIVALENCE_MIN_PCT = 99.0
P50_REDUCTION_MIN_PCT = 20.0

# Text model hyper-parameters.
NGRAM_RANGE = (1, 2)
MIN_DF = 2
MAX_FEATURES = 20000
INVERSE_REGULARISATION_C = 0.1
MAX_ITER = 2000

# Admission limits for one text (characters, inclusive) and for one batch.
MIN_TEXT_CHARS = 1
MAX_TEXT_CHARS = 20000
MAX_BATCH_TEXTS = 64

# Request-duration histogram bounds (seconds); +Inf is implicit.
REQUEST_DURATION_BUCKETS: tuple[float, ...] = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0)

# Default histogram bounds (seconds) of the metrics library; +Inf is implicit.
DEFAULT_DURATION_BUCKETS: tuple[float, ...] = (
    0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0,
)

# Endpoint label for requests that matched no route; path never instrumented.
UNMATCHED_ENDPOINT = "unmatched"
METRICS_PATH = "/metrics"

# Backend -> model type of the model-info gauge; unknown backends map to themselves.
MODEL_TYPE_BY_BACKEND: dict[str, str] = {
    "sklearn": "sklearn-pipeline",
    "onnx": "onnx-runtime",
}

# Sampling defaults of the latency tools.
DEFAULT_SEED = 42
DEFAULT_WARMUP = 20
DEFAULT_SAMPLES = 200
TEST_SIZE = 0.2
# ------------------------------------------------------------ end fixed values

# Output column order of the labelled table.
LABELLED_COLUMNS: tuple[str, ...] = (
    "id",
    "text",
    "condition_label",
    "condition_name",
    "urgency_score",
    "label",
    "split",
)
