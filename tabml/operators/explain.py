"""Explanations of predictions as columns: narrow projections over a scored DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabml.functions import fixed
from tabml.functions.values import format_number


def main_signals(strengths: Column, names: Sequence[str], top: int = fixed.SIGNALS) -> Column:
    """The strongest features as `ARRAY<STRUCT<name, contribution, direction>>`, feature order on ties."""
    labels = F.array(*[F.lit(n) for n in names])
    indexed = F.transform(strengths, lambda s, i: F.struct((-s).alias("minus"), i.alias("i")))
    # Sorted by falling strength, then by position.
    best = F.filter(F.slice(F.array_sort(indexed), 1, top), lambda s: s["minus"] < 0)
    features = F.col("features")
    return F.transform(
        best,
        lambda s: F.struct(
            F.element_at(labels, s["i"] + 1).alias("name"),
            (-s["minus"]).alias("contribution"),
            F.when(F.element_at(features, s["i"] + 1) >= 0, fixed.ABOVE).otherwise(fixed.BELOW).alias("direction"),
        ),
    )


def _percent(share: Column) -> Column:
    return F.floor(share * 100 + 0.5).cast("string")


def explain_classes(df: DataFrame, labels: Sequence[str], class_rows: DataFrame | None = None) -> DataFrame:
    """Add `headline`, `why`, `why_not` from `probability`: winner and runner-up with percentages.

    With too many classes for a list of labels, names are joined from `class_rows (class, class_index)`.
    """
    names = F.array(*[F.lit(v) for v in labels])
    ranked = F.array_sort(F.transform("probability", lambda p, i: F.struct((-p).alias("minus"), i.alias("i"))))

    def name(place: int) -> Column:
        if class_rows is not None:
            return F.col(f"_name{place}")
        return F.element_at(names, F.col("_ranked")[place - 1]["i"] + 1)

    def share(place: int) -> Column:
        return _percent(-F.col("_ranked")[place - 1]["minus"])

    scored = df.withColumn("_ranked", ranked)
    if class_rows is not None:
        for place in (1, 2):
            side = class_rows.select(F.col("class_index").cast("int").alias("_at"), F.col("class").alias(f"_name{place}"))
            scored = scored.join(side, F.col("_ranked")[place - 1]["i"] == F.col("_at"), "left").drop("_at")
    rival = F.lit(fixed.CLASS_NO_RIVAL)
    if len(labels) > 1 or class_rows is not None:
        rival = F.concat(name(2), F.lit(fixed.CLASS_WHY_NOT[0]), share(2), F.lit(fixed.CLASS_WHY_NOT[1]))
    return scored.withColumns(
        {
            "headline": F.concat(F.lit(fixed.CLASS_HEADLINE), name(1)),
            "why": F.concat(F.lit(fixed.CLASS_WHY[0]), share(1), F.lit(fixed.CLASS_WHY[1])),
            "why_not": rival,
        }
    ).drop("_ranked", "_name1", "_name2")


def explain_values(df: DataFrame, kind: str) -> DataFrame:
    why = fixed.VALUE_WHY_LINEAR if kind == "linearRegression" else fixed.VALUE_WHY_OTHER
    return df.withColumns(
        {
            "headline": F.concat(F.lit(fixed.VALUE_HEADLINE), format_number(F.col("prediction"))),
            "why": F.lit(why),
            "why_not": F.lit(fixed.VALUE_WHY_NOT),
        }
    )


def explain_clusters(df: DataFrame) -> DataFrame:
    noise = F.col("prediction") == fixed.DBSCAN["noise"]
    name = F.when(noise, fixed.CLUSTER_NOISE).otherwise(F.col("prediction").cast("int").cast("string"))
    return df.withColumns(
        {
            "headline": F.concat(F.lit(fixed.CLUSTER_HEADLINE), name),
            "why": F.when(noise, fixed.CLUSTER_WHY_NOISE).otherwise(fixed.CLUSTER_WHY),
            "why_not": F.lit(fixed.CLUSTER_WHY_NOT),
        }
    )


def explain(problem_type: str, model, df: DataFrame, names: Sequence[str], labels: Sequence[str] = (), class_rows: DataFrame | None = None) -> DataFrame:
    """Score `df` and add `headline`, `why`, `why_not` and `signals`."""
    scored = model.transform(df)
    if problem_type == "classification":
        explained = explain_classes(scored, labels, class_rows)
    elif problem_type == "regression":
        explained = explain_values(scored, model.kind)
    else:
        explained = explain_clusters(scored)
    return explained.withColumn("signals", main_signals(model.contributions(), names))


def predicted_label(labels: Sequence[str]) -> Column:
    """Class name of the predicted index."""
    return F.element_at(F.array(*[F.lit(v) for v in labels]), F.col("prediction").cast("int") + 1)
