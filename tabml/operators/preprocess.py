"""Fitted preprocessing: impute, cap, standardise, one-hot encode, encode the target."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.base import Estimator, Model
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabml.functions import fixed
from tabml.functions.values import as_number, as_text, clamp
from tabml.operators.ordering import dense_positions
from tabml.operators.profile import as_text_label, feature_columns, kinds_of, quartiles, value_frequencies
from tabml.operators.sampling import usable_rows
from tabml.sources.scratch import stored

# Up to this many classes the encoder is a literal map; beyond it a join.
LITERAL_CLASSES = 256
# More classes than this are not gathered: the encoder stays a table then, and names of classes are joined.
MAX_DRIVER_CLASSES = 100_000


@dataclass
class NumericStats:
    median: float
    q1: float
    q3: float
    lower: float
    upper: float
    mean: float = 0.0
    std: float = 1.0
    missing: int = 0


@dataclass
class CategoricalStats:
    mode: str
    categories: list[str] = field(default_factory=list)
    missing: int = 0


def fit_numeric(df: DataFrame, columns: Sequence[str], missing: dict[str, int], quantiles: str = "exact") -> tuple[dict[str, NumericStats], int]:
    """Statistics per column and the number of values outside the fences.

    Two jobs: quartiles, then one aggregate over all columns with the fences as literals.
    """
    if not columns:
        return {}, 0
    found = {r["column"]: (r["q1"], r["median"], r["q3"]) for r in quartiles(df, columns, quantiles).collect()}
    stats = {}
    for c in columns:
        q1, median, q3 = found.get(c, (0.0, 0.0, 0.0))
        reach = fixed.IQR_FACTOR * (q3 - q1)
        stats[c] = NumericStats(median, q1, q3, q1 - reach, q3 + reach, missing=missing.get(c, 0))
    # Imputed values are columns of their own, so that the aggregates below do not parse text again.
    filled_rows = df.select(*[F.coalesce(as_number(df, c), F.lit(stats[c].median)).alias(f"v{i}") for i, c in enumerate(columns)])
    aggregates = []
    for i, c in enumerate(columns):
        s, filled = stats[c], F.col(f"v{i}")
        kept = clamp(filled, s.lower, s.upper)
        aggregates += [
            F.avg(kept).alias(f"mean{i}"),
            F.stddev_pop(kept).alias(f"std{i}"),
            F.count_if((filled < s.lower) | (filled > s.upper)).alias(f"out{i}"),
        ]
    row = filled_rows.agg(*aggregates).first()
    for i, c in enumerate(columns):
        stats[c].mean = row[f"mean{i}"] or 0.0
        stats[c].std = row[f"std{i}"] or 1.0
    return stats, sum(row[f"out{i}"] for i in range(len(columns)))


def top_categories(df: DataFrame, columns: Sequence[str], limit: int = fixed.MAX_CATEGORIES) -> DataFrame:
    """`(column, category, n, rank)`: the most frequent values, missing ones as a category of their own.

    The rank limit is applied in every task before the shuffle, so a column with very many values
    sends only `limit` rows per task to its window.
    """
    counts = value_frequencies(df, columns, fixed.MISSING_CATEGORY).withColumnRenamed("value", "category")
    window = Window.partitionBy("column").orderBy(F.desc("n"), "category")
    return counts.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= limit)


def fit_categorical(df: DataFrame, columns: Sequence[str], missing: dict[str, int]) -> dict[str, CategoricalStats]:
    if not columns:
        return {}
    found: dict[str, list[tuple[int, str]]] = {c: [] for c in columns}
    for r in top_categories(df, columns).collect():
        found[r["column"]].append((r["rank"], r["category"]))
    stats = {}
    for c in columns:
        categories = [category for _, category in sorted(found[c])]
        mode = categories[0] if categories else fixed.MISSING_CATEGORY
        if fixed.OTHER_CATEGORY not in categories:
            categories.append(fixed.OTHER_CATEGORY)
        stats[c] = CategoricalStats(mode, categories, missing.get(c, 0))
    return stats


def class_table(df: DataFrame, target: str) -> DataFrame:
    """`(class, class_index)`: distinct labels in text order, numbered from 0."""
    classes = df.select(as_text_label(df, target).alias("class")).where(F.col("class").isNotNull()).distinct()
    return dense_positions(classes, ["class"], "class_index")


class TabularPreprocessor(Estimator):
    """Learns a numeric feature vector from raw columns of any type.

    Statistics come from all usable rows given to `fit`; pass only training rows to keep holdout
    rows out of them. `quantiles="approx"` trades exact quartiles for bounded memory.
    """

    def __init__(self, target: str | None = None, problem_type: str = "unsupervised", features: Sequence[str] | None = None, quantiles: str = "exact"):
        super().__init__()
        self.target, self.problem_type, self.features, self.quantiles = target, problem_type, features, quantiles

    def _fit(self, dataset: DataFrame) -> "TabularModel":
        rows = usable_rows(dataset, self.target, self.problem_type)
        features = list(self.features) if self.features is not None else feature_columns(dataset, self.target)
        kinds, missing = kinds_of(rows, features)
        numeric = [c for c in features if kinds[c] == "numeric"]
        categorical = [c for c in features if kinds[c] != "numeric"]
        numeric_stats, outliers = fit_numeric(rows, numeric, missing, self.quantiles)
        categorical_stats = fit_categorical(rows, categorical, missing)
        classes = class_rows = None
        if self.problem_type == "classification":
            table = class_table(rows, self.target)
            if table.count() <= MAX_DRIVER_CLASSES:
                classes = [r["class"] for r in table.orderBy("class").collect()]
            else:
                class_rows = stored(table, "classes")
        return TabularModel(self.target, self.problem_type, features, numeric_stats, categorical_stats, classes, outliers, sum(missing.values()), class_rows)


class TabularModel(Model):
    """Adds `features ARRAY<DOUBLE>` and, when the target is present, `label`: a narrow projection."""

    def __init__(self, target, problem_type, features, numeric_stats, categorical_stats, classes, outlier_count, missing_count, class_rows=None):
        super().__init__()
        self.target, self.problem_type, self.input_columns = target, problem_type, features
        self.numeric_stats: dict[str, NumericStats] = numeric_stats
        self.categorical_stats: dict[str, CategoricalStats] = categorical_stats
        # The names of the classes in order; beyond `MAX_DRIVER_CLASSES` only their table `(class, class_index)`.
        self.classes: list[str] | None = classes
        self.class_rows: DataFrame | None = class_rows
        self.outlier_count, self.missing_count = outlier_count, missing_count

    @property
    def feature_names(self) -> list[str]:
        names = list(self.numeric_stats)
        for c, stats in self.categorical_stats.items():
            names += [f"{c} = {category}" for category in stats.categories]
        return names

    def numeric_feature(self, df: DataFrame, name: str) -> Column:
        s = self.numeric_stats[name]
        value = clamp(F.coalesce(as_number(df, name), F.lit(s.median)), s.lower, s.upper)
        return (value - F.lit(s.mean)) / F.lit(s.std)

    def category(self, df: DataFrame, name: str) -> Column:
        """The known category of a cell: the mode for missing, `__other__` for unknown ones."""
        s = self.categorical_stats[name]
        text = F.coalesce(as_text(df, name), F.lit(s.mode))
        return F.when(text.isin(*s.categories), text).otherwise(F.lit(fixed.OTHER_CATEGORY))

    def feature_vector(self, df: DataFrame) -> Column:
        slots = [self.numeric_feature(df, c) for c in self.numeric_stats]
        for c, stats in self.categorical_stats.items():
            own = self.category(df, c)
            slots += [(own == category).cast("double") for category in stats.categories]
        return F.array(*slots) if slots else F.array().cast("array<double>")

    def label(self, df: DataFrame) -> Column:
        if self.problem_type == "regression":
            return as_number(df, self.target)
        pairs = [F.lit(v) for i, c in enumerate(self.classes) for v in (c, float(i))]
        return F.create_map(*pairs)[as_text_label(df, self.target)] if pairs else F.lit(None).cast("double")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        result = dataset.withColumn("features", self.feature_vector(dataset))
        if self.problem_type == "unsupervised" or self.target not in dataset.columns:
            return result
        if self.problem_type == "classification" and (self.classes is None or len(self.classes) > LITERAL_CLASSES):
            return self._join_labels(result, dataset)
        return result.withColumn("label", self.label(dataset))

    def _join_labels(self, result: DataFrame, dataset: DataFrame) -> DataFrame:
        if self.classes is None:
            table = self.class_rows.select(F.col("class").alias("_class"), F.col("class_index").cast("double").alias("label"))
        else:
            rows = [(c, float(i)) for i, c in enumerate(self.classes)]
            table = dataset.sparkSession.createDataFrame(rows, "_class string, label double")
        return result.withColumn("_class", as_text_label(dataset, self.target)).join(table, "_class", "left").drop("_class")

    def stats_table(self, spark) -> DataFrame:
        """`(column, median, q1, q3, lower, upper, mean, std, missing)`."""
        rows = [(c, s.median, s.q1, s.q3, s.lower, s.upper, s.mean, s.std, s.missing) for c, s in self.numeric_stats.items()]
        return spark.createDataFrame(
            rows, "column string, median double, q1 double, q3 double, lower double, upper double, mean double, std double, missing bigint"
        )

    def categories_table(self, spark) -> DataFrame:
        """`(column, mode, categories, missing)`."""
        rows = [(c, s.mode, s.categories, s.missing) for c, s in self.categorical_stats.items()]
        return spark.createDataFrame(rows, "column string, mode string, categories array<string>, missing bigint")

    def feature_table(self, spark) -> DataFrame:
        return spark.createDataFrame(list(enumerate(self.feature_names)), "position bigint, name string")

    def summary(self, spark) -> DataFrame:
        """`(step, title, body)`: what preprocessing did, in order."""
        counts = {
            "Missing values": self.missing_count,
            "Outliers": self.outlier_count,
            "Encoding": len(self.categorical_stats),
            "Scaling": len(self.numeric_stats),
        }
        rows = [(title, fixed.SUMMARY[title][n > 0].format(n=n)) for title, n in counts.items()]
        if self.problem_type == "classification":
            title, body = fixed.SUMMARY_TARGET
            # beyond `MAX_DRIVER_CLASSES` their number stands for their names
            named = ", ".join(self.classes) if self.classes is not None else f"{self.class_rows.count()} classes"
            rows.append((title, body.format(classes=named)))
        return spark.createDataFrame([(i, *r) for i, r in enumerate(rows, start=1)], "step int, title string, body string")

    def kind_counts(self, spark) -> DataFrame:
        rows = [("Numeric", len(self.numeric_stats)), ("Categorical", len(self.categorical_stats)), ("Encoded", len(self.feature_names))]
        return spark.createDataFrame(rows, "kind string, n bigint")


def health_summary(df: DataFrame, model: TabularModel, rationale: str) -> DataFrame:
    """`(rows, columns, numeric, categorical, features, encoded, task, rationale)`."""
    columns = feature_columns(df)
    kinds, _ = kinds_of(df, columns)
    numeric = sum(k == "numeric" for k in kinds.values())
    values = {
        "columns": len(columns), "numeric_columns": numeric, "categorical_columns": len(columns) - numeric,
        "features": len(model.input_columns), "encoded_features": len(model.feature_names),
    }
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", *[F.lit(v).cast("bigint").alias(k) for k, v in values.items()],
        F.lit(model.problem_type.capitalize()).alias("task"), F.lit(rationale).alias("rationale"),
    )

