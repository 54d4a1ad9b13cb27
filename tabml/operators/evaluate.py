"""Model quality from a DataFrame with `label` and `prediction`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.functions import fixed


def regression_metrics(df: DataFrame) -> DataFrame:
    """`(mae, rmse, r2, rows)` in one aggregate; R2 divides by 1 when all labels are equal."""
    error = F.col("prediction") - F.col("label")
    n = F.count("label")
    total = F.var_pop("label") * n
    return df.agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (1 - F.sum(error * error) / F.when(total == 0, F.lit(1.0)).otherwise(total)).alias("r2"),
        n.alias("rows"),
    )


def _counts(df: DataFrame) -> DataFrame:
    return df.groupBy(F.col("label").cast("bigint").alias("actual"), F.col("prediction").cast("bigint").alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(df: DataFrame, classes: int) -> DataFrame:
    """`(actual, predicted, n)` for every pair of classes, zeros included."""
    cells = df.sparkSession.range(classes * classes).select(
        F.floor(F.col("id") / classes).alias("actual"), (F.col("id") % classes).alias("predicted")
    )
    return cells.join(_counts(df), ["actual", "predicted"], "left").select("actual", "predicted", F.coalesce("n", F.lit(0)).alias("n"))


def confusion_view(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """`(pair, n)`: counts under `actual -> predicted` names, row by row."""
    names = F.array(*[F.lit(v) for v in labels])
    pair = F.concat(F.element_at(names, F.col("actual").cast("int") + 1), F.lit(" -> "), F.element_at(names, F.col("predicted").cast("int") + 1))
    return confusion_matrix(df, len(labels)).orderBy("actual", "predicted").select(pair.alias("pair"), "n")


def class_metrics(df: DataFrame, classes: int) -> DataFrame:
    """`(class_index, precision, recall, f1)` per class, 0 where a denominator is 0."""
    # One exploded row per class side of a counted pair: the input was reduced to pairs before.
    hit = F.col("actual") == F.col("predicted")
    sides = _counts(df).select(
        F.explode(
            F.array(
                F.struct(F.col("actual").alias("c"), F.when(hit, F.col("n")).otherwise(0).alias("tp"), F.lit(0).cast("bigint").alias("fp"), F.when(hit, 0).otherwise(F.col("n")).alias("fn")),
                F.struct(F.col("predicted").alias("c"), F.lit(0).cast("bigint").alias("tp"), F.when(hit, 0).otherwise(F.col("n")).alias("fp"), F.lit(0).cast("bigint").alias("fn")),
            )
        ).alias("s")
    )
    sums = sides.groupBy(F.col("s.c").alias("c")).agg(F.sum("s.tp").alias("tp"), F.sum("s.fp").alias("fp"), F.sum("s.fn").alias("fn"))
    all_classes = df.sparkSession.range(classes).select(F.col("id").alias("c"))

    def ratio(part, whole):
        return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)

    scored = all_classes.join(sums, "c", "left").na.fill(0).select(
        F.col("c").alias("class_index"),
        ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
    )
    both = F.col("precision") + F.col("recall")
    return scored.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), both))


def classification_metrics(df: DataFrame, classes: int) -> DataFrame:
    """`(accuracy, macro_f1, classes, rows)`; the mean F1 is over all classes, also unseen ones."""
    macro = class_metrics(df, classes).agg(F.avg("f1").alias("macro_f1"))
    hits = df.agg(F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy"), F.count("label").alias("rows"))
    # Two one-row results side by side.
    return (
        hits.withColumn("_one", F.lit(1)).join(macro.withColumn("_one", F.lit(1)), "_one")
        .select("accuracy", "macro_f1", F.lit(classes).cast("bigint").alias("classes"), "rows")
    )


def evaluate(problem_type: str, model, df: DataFrame, classes: int | None = None) -> DataFrame:
    """Score `df` and return its metrics."""
    scored = model.transform(df)
    if problem_type == "regression":
        return regression_metrics(scored)
    if problem_type == "classification":
        return classification_metrics(scored, classes)
    return cluster_summary(scored)


def actual_vs_predicted(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, F.col("label").alias("actual"), F.col("prediction").alias("predicted"))


def cluster_summary(df: DataFrame) -> DataFrame:
    """`(clusters, noise, rows)`."""
    noise = F.col("prediction") == fixed.DBSCAN["noise"]
    sizes = df.groupBy("prediction").agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.count_if(~noise).alias("clusters"),
        F.coalesce(F.sum(F.when(noise, F.col("n"))), F.lit(0)).alias("noise"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
    )


def importance_ranking(spark, importances: Sequence[float], names: Sequence[str], top: int = fixed.TOP_ROWS) -> DataFrame:
    """`(position, name, importance, percent)`: strongest features, percent of the strongest one.

    Empty when no feature has any importance.
    """
    rows = [(i, n, abs(float(v))) for i, (n, v) in enumerate(zip(names, importances))]
    table = spark.createDataFrame(rows, "position bigint, name string, importance double")
    best = max((r[2] for r in rows), default=0.0)
    share = F.floor(F.col("importance") / F.lit(max(best, 1e-9)) * 100 + 0.5).alias("percent")
    return table.where(F.lit(best > 0)).orderBy(F.desc("importance"), "position").limit(top).select("*", share)
