"""What every trained model offers."""

from __future__ import annotations

from pyspark.ml.base import Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabml.functions import vectors


class FittedModel(Model):
    """`transform` adds `prediction` and, for classifiers, `probability ARRAY<DOUBLE>`."""

    kind = ""
    has_probability = False

    def __init__(self, importances: list[float], details: dict | None = None):
        super().__init__()
        self.importances = [float(v) for v in importances]
        self.details = details or {}

    def contributions(self) -> Column:
        """Strength of each feature for one prediction."""
        if len(self.importances) == 0:
            return F.array().cast("array<double>")
        return F.zip_with(F.col("features"), vectors.array_literal(self.importances), lambda x, w: F.abs(x) * w)


def with_class_scores(df: DataFrame, scores: list[Column]) -> DataFrame:
    """Add `probability` and `prediction` from one score per class.

    The scores are a column of their own, so that they are computed once and by generated code.
    """
    scored = df.withColumn("_scores", F.array(*scores))
    probability, prediction = vectors.softmax(F.col("_scores")), vectors.argmax(F.col("_scores"))
    return scored.withColumns({"probability": probability, "prediction": prediction}).drop("_scores")


def width(df: DataFrame) -> int:
    row = df.select(F.size("features")).first()
    if row is None:
        raise ValueError("No training rows are available.")
    return row[0]


def class_count(df: DataFrame) -> int:
    return int(df.agg(F.max("label")).first()[0]) + 1


def vector(name: str = "features") -> Column:
    return array_to_vector(F.col(name))


def dispersion(df: DataFrame) -> list[float]:
    """Population standard deviation per feature, in one pass."""
    row = df.agg(Summarizer.metrics("variance", "count").summary(vector()).alias("s")).first()["s"]
    n = row["count"]
    return [float((v * (n - 1) / n) ** 0.5) if n > 1 else 0.0 for v in row["variance"].toArray()]


def dispersion_table(df: DataFrame, names: list[str]) -> DataFrame:
    """`(position, name, dispersion)`: spread per encoded feature."""
    rows = [(i, names[i], v) for i, v in enumerate(dispersion(df))]
    return df.sparkSession.createDataFrame(rows, "position bigint, name string, dispersion double")
