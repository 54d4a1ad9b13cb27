"""Constants and texts that results must reproduce exactly."""

# Text tokens that mean "missing" (compared trimmed, lower case).
MISSING_TOKENS = ("", "na", "n/a", "null", "none", "undefined", "?")

# Characters removed before a number is read.
NUMBER_NOISE = "$,%"

# Field separators tried, in order of preference.
DELIMITERS = (",", ";", "\t", "|")

# Profile and preprocessing rules.
NUMERIC_RATIO = 0.85
IQR_FACTOR = 1.5
MAX_CATEGORIES = 12
MISSING_CATEGORY = "__missing__"
OTHER_CATEGORY = "__other__"
PREVIEW_ROWS = 8
TOP_ROWS = 8

# Deciding whether a numeric target holds classes.
INTEGER_TOLERANCE = 1e-9
CLASS_MIN = 2
CLASS_MAX = 20
CLASS_SHARE = 0.12

# Histogram bins.
MIN_BINS = 4
MAX_BINS = 8

# Sampling.
ROW_CAP = 2500
DBSCAN_ROW_CAP = 650
HOLDOUT_RATIO = 0.25
HOLDOUT_SEED = 17

# Learner settings.
LINEAR = {"rate": 0.04, "epochs": 900, "l2": 0.001}
SOFTMAX = {"rate": 0.08, "epochs": 520, "l2": 0.001}
KNN_MIN, KNN_MAX, KNN_OFFSET = 3, 7, 1e-6
BAYES_PRIOR_FLOOR, BAYES_VARIANCE_FLOOR = 1e-6, 1e-4
TREE = {"depth": 6, "min_rows": 4, "min_gain": 1e-9}
TREE_CANDIDATES = 12
FOREST = {"depth": 7, "min_rows": 4, "min_gain": 1e-9, "seed": 19,
          "classification_trees": 17, "regression_trees": 15}
KMEANS = {"k": 3, "rounds": 80, "seed": 29}
DBSCAN = {"min_pts_low": 3, "min_pts_high": 5, "eps_neighbor": 5,
          "eps_quantile": 0.65, "noise": -1}
PCA = {"steps": 80, "first": 1.0, "rest": 0.3}
SIGNALS = 4

# Algorithm ids by problem type.
ALGORITHMS = {
    "classification": ("logistic", "knnClassifier", "naiveBayes", "treeClassifier", "forestClassifier"),
    "regression": ("linearRegression", "knnRegressor", "treeRegressor", "forestRegressor"),
    "unsupervised": ("kmeans", "dbscan"),
}

# Texts shown to the user.
WHY_UNSUPERVISED = "No target is required, so the app will look for natural groups in the feature space."
WHY_LABELS = 'The target "{target}" contains labels or categories, so the task is classification.'
WHY_FEW_VALUES = 'The target "{target}" is numeric but has only {n} repeated class-like values.'
WHY_MANY_VALUES = 'The target "{target}" is numeric with many possible values, so the task is regression.'

SUMMARY = {
    "Missing values": (
        "No missing feature values were found.",
        "{n} missing feature value(s) were imputed. Numeric columns used the median; categorical columns used the mode.",
    ),
    "Outliers": (
        "No strong numeric outliers were detected by the IQR rule.",
        "{n} numeric value(s) were capped using the IQR lower and upper fences so extreme points do not dominate training.",
    ),
    "Encoding": (
        "No categorical feature encoding was needed.",
        "{n} categorical column(s) were one-hot encoded so algorithms can learn from labels.",
    ),
    "Scaling": (
        "No numeric feature scaling was needed.",
        "{n} numeric column(s) were standardized to mean 0 and standard deviation 1.",
    ),
}
SUMMARY_TARGET = ("Target encoding", "The target was converted into class ids: {classes}.")

ABOVE, BELOW = "above typical", "below typical"
CLASS_HEADLINE = "Predicted class: "
CLASS_WHY = ("The selected class had the strongest model score at ", "%.")
CLASS_WHY_NOT = (" was not selected because its score was lower at ", "%.")
CLASS_NO_RIVAL = "No competing class was close enough to replace the prediction."
VALUE_HEADLINE = "Predicted value: "
VALUE_WHY_LINEAR = "The model started from the target average and adjusted the number using learned feature weights."
VALUE_WHY_OTHER = "The model compared this row with learned groups or neighbors and returned the most likely numeric value."
VALUE_WHY_NOT = (
    "Regression models choose a continuous value, so there is no second class. "
    "A different value would need stronger evidence from the feature pattern."
)
CLUSTER_HEADLINE = "Assigned cluster: "
CLUSTER_NOISE = "Noise / outlier"
CLUSTER_WHY = "The row was closest to the learned cluster pattern after preprocessing."
CLUSTER_WHY_NOISE = "The row did not sit close enough to a dense learned group."
CLUSTER_WHY_NOT = "Other clusters were farther away in the standardized feature space."
TARGET_CAPTIONS = {
    "unsupervised": "No target column",
    "regression": "{n} numeric target values",
    "classification": "{n} target class(es)",
}
NO_IMPORTANCE = "This model did not expose a strong feature-importance signal."
CSV_TOO_SHORT = "The CSV needs one header row and at least one data row."
