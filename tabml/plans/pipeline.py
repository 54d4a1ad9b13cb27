"""The whole flow: diagnose, preprocess, split, train, evaluate, score and explain."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.functions import fixed
from tabml.functions.values import col
from tabml.operators.evaluate import cluster_summary, evaluate
from tabml.operators.explain import explain, predicted_label
from tabml.operators.learners.base import FittedModel
from tabml.operators.preprocess import TabularModel, TabularPreprocessor
from tabml.operators.profile import diagnose
from tabml.operators.sampling import holdout, systematic_sample, usable_rows
from tabml.operators.training import train
from tabml.sources import models
from tabml.sources.rows import ROW_ID
from tabml.sources.scratch import checkpointed


@dataclass
class Analysis:
    """A diagnosed table with its fitted preprocessor."""

    table: DataFrame | None
    target: str | None
    problem_type: str
    rationale: str
    preprocessor: TabularModel
    key: str

    def prepared(self) -> DataFrame:
        """Usable rows with `features` and `label`."""
        return self.preprocessor.transform(usable_rows(self.table, self.target, self.problem_type))


@dataclass
class Trained:
    analysis: Analysis
    model: FittedModel
    metrics: DataFrame
    training_rows: DataFrame | None
    test_rows: DataFrame | None

    def score(self, raw: DataFrame) -> DataFrame:
        """Predictions for raw rows; adds `predicted_label` for classes."""
        scored = self.model.transform(self.analysis.preprocessor.transform(raw))
        labels = self.analysis.preprocessor.classes
        if labels:
            return scored.withColumn("predicted_label", predicted_label(labels))
        table = self.analysis.preprocessor.class_rows
        if table is None:
            return scored
        named = table.select(F.col("class_index").cast("double").alias("_index"), F.col("class").alias("predicted_label"))
        return scored.join(named, F.col("prediction") == F.col("_index"), "left").drop("_index")

    def save(self, path: str) -> None:
        """Write what scoring and explaining need, and the metrics; the training rows stay behind."""
        spark = self.metrics.sparkSession
        models.save_preprocessor(spark, self.analysis.preprocessor, f"{path}/preprocessor")
        models.save_model(spark, self.model, f"{path}/model")
        self.metrics.write.parquet(f"{path}/metrics")
        found = [(self.analysis.target, self.analysis.problem_type, self.analysis.rationale, self.analysis.key)]
        spark.createDataFrame(found, "target string, problem_type string, rationale string, key string").coalesce(1).write.parquet(f"{path}/analysis")

    def explain(self, raw: DataFrame) -> DataFrame:
        a = self.analysis
        return explain(a.problem_type, self.model, a.preprocessor.transform(raw), a.preprocessor.feature_names, a.preprocessor.classes or (), a.preprocessor.class_rows)


def load_trained(spark: SparkSession, path: str) -> Trained:
    """What `Trained.save` wrote, without table, training and test rows."""
    found = spark.read.parquet(f"{path}/analysis").first()
    preprocessor = models.load_preprocessor(spark, f"{path}/preprocessor")
    analysis = Analysis(None, found["target"], found["problem_type"], found["rationale"], preprocessor, found["key"])
    return Trained(analysis, models.load_model(spark, f"{path}/model"), spark.read.parquet(f"{path}/metrics"), None, None)


def analyze(df: DataFrame, target: str | None = None, mode: str = "auto", key: str = ROW_ID, quantiles: str = "exact") -> Analysis:
    """Decide the task and fit the preprocessor on all usable rows."""
    found = diagnose(df, target, mode).first()
    features = [c for c in df.columns if c not in (key, target, ROW_ID)]
    fitted = TabularPreprocessor(target, found["problem_type"], features, quantiles).fit(df)
    return Analysis(df, target, found["problem_type"], found["rationale"], fitted, key)


def train_and_evaluate(analysis: Analysis, algorithm: str, row_cap: int | None = None, **options) -> Trained:
    """Split off the holdout (supervised tasks), train on the rest and evaluate.

    `row_cap` bounds the labelled rows a classifier is trained on, by a systematic sample of the training
    rows; the holdout is never cut. Without it all rows are used.
    """
    if row_cap is not None and analysis.problem_type != "classification":
        raise ValueError("row_cap is for classification only.")
    # The raw table is parsed once more here; split, training and evaluation read the encoded rows.
    encoded = [analysis.key, "features"] + (["label"] if analysis.problem_type != "unsupervised" else [])
    rows = checkpointed(analysis.prepared().select(*[col(c) for c in encoded]))
    if algorithm in ("knnClassifier", "knnRegressor", "forestClassifier", "forestRegressor", "kmeans", "dbscan"):
        options.setdefault("key", analysis.key)
    if analysis.problem_type == "unsupervised":
        model = train("unsupervised", algorithm, rows, **options)
        assigned = model.assignments if algorithm == "dbscan" else model.transform(rows)
        return Trained(analysis, model, cluster_summary(assigned), rows, None)
    classes = analysis.preprocessor.classes
    if classes is not None:
        count = len(classes)
    else:
        count = analysis.preprocessor.class_rows.count() if analysis.problem_type == "classification" else None
    if count:
        options.setdefault("classes", count)
    split = holdout(rows, fixed.HOLDOUT_RATIO, fixed.HOLDOUT_SEED, analysis.key)
    training, test = split.where(~F.col("is_test")), split.where("is_test")
    if row_cap is not None:
        training = systematic_sample(training, row_cap, analysis.key)
    model = train(analysis.problem_type, algorithm, training, **options)
    return Trained(analysis, model, evaluate(analysis.problem_type, model, test, count), training, test)

