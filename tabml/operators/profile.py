"""Profiling and exploratory aggregates. Every function returns a DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabml.functions import fixed
from tabml.functions.values import as_number, as_text, col, is_missing, is_numeric_type, text_to_number
from tabml.operators.ordering import exact_quantiles
from tabml.operators.sampling import usable_rows
from tabml.sources.rows import ROW_ID


def feature_columns(df: DataFrame, target: str | None = None) -> list[str]:
    """All columns but the row id and the target; the target is left out even without supervision."""
    return [c for c in df.columns if c not in (ROW_ID, target)]


def value_frequencies(df: DataFrame, columns: Sequence[str], missing: str | None = None) -> DataFrame:
    """`(column, value, n)`: distinct trimmed text values per column; `missing`, NULL by default, for missing ones.

    Copies of a value are counted before the shuffle, so a hot value costs one row per task.
    """
    texts = df.select(*[F.coalesce(as_text(df, c), F.lit(missing).cast("string")).alias(c) for c in columns])
    return (
        texts.unpivot([], [col(c) for c in columns], "column", "value")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _position(columns: Sequence[str]) -> Column:
    return F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("column")) - 1


def profile_columns(df: DataFrame, columns: Sequence[str] | None = None, distinct: str = "exact") -> DataFrame:
    """`(column, position, kind, missing, unique, numeric_ratio)`, one row per column.

    `distinct="approx"` replaces the exact distinct counts, which shuffle every distinct value, by
    sketches in a single pass.
    """
    columns = list(columns if columns is not None else feature_columns(df))
    typed = [c for c in columns if is_numeric_type(df.schema[c].dataType)]
    if distinct == "approx":
        stats = _approximate_profile(df, columns)
    else:
        n = F.col("n")
        present = F.col("value").isNotNull()
        stats = value_frequencies(df, columns).groupBy("column").agg(
            F.sum(F.when(present, 0).otherwise(n)).alias("missing"),
            F.count("value").alias("unique"),
            F.sum(F.when(present, n).otherwise(0)).alias("present"),
            F.sum(F.when(text_to_number(F.col("value")).isNotNull(), n).otherwise(0)).alias("parsed"),
        )
    ratio = F.when(F.col("present") == 0, F.lit(0.0)).otherwise(F.col("parsed") / F.col("present"))
    by_type = F.col("column").isin(typed) if typed else F.lit(False)
    kind = F.when(by_type | (F.col("numeric_ratio") >= fixed.NUMERIC_RATIO), "numeric").otherwise("categorical")
    return (
        stats.withColumn("numeric_ratio", ratio)
        .select("column", _position(columns).cast("int").alias("position"), kind.alias("kind"), "missing", "unique", "numeric_ratio")
    )


def _approximate_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    per_column = [
        F.struct(
            F.lit(c).alias("column"),
            F.count_if(is_missing(df, c)).alias("missing"),
            F.approx_count_distinct(as_text(df, c), 0.01).alias("unique"),
            F.count_if(~is_missing(df, c)).alias("present"),
            F.count(as_number(df, c)).alias("parsed"),
        )
        for c in columns
    ]
    return df.agg(F.array(*per_column).alias("stats")).select(F.inline("stats"))


def kinds_of(df: DataFrame, columns: Sequence[str]) -> tuple[dict[str, str], dict[str, int]]:
    """Column kinds and missing counts without distinct counts: one narrow pass, one result row."""
    if not columns:
        return {}, {}
    row = df.agg(
        *[F.count_if(is_missing(df, c)).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.count(as_number(df, c)).alias(f"p{i}") for i, c in enumerate(columns)],
        F.count(F.lit(1)).alias("n"),
    ).first()
    kinds, missing = {}, {}
    for i, c in enumerate(columns):
        present = row["n"] - row[f"m{i}"]
        ratio = row[f"p{i}"] / present if present else 0.0
        numeric = is_numeric_type(df.schema[c].dataType) or ratio >= fixed.NUMERIC_RATIO
        kinds[c], missing[c] = ("numeric" if numeric else "categorical"), row[f"m{i}"]
    return kinds, missing


def profile_dataset(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: row, column, numeric, categorical and missing counts."""
    columns = list(columns if columns is not None else feature_columns(df))
    kinds, missing = kinds_of(df, columns)
    numeric = sum(k == "numeric" for k in kinds.values())
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows",
        F.lit(len(columns)).cast("bigint").alias("columns"),
        F.lit(numeric).cast("bigint").alias("numeric_columns"),
        F.lit(len(columns) - numeric).cast("bigint").alias("categorical_columns"),
        F.lit(sum(missing.values())).cast("bigint").alias("missing"),
    )


def missing_ranking(df: DataFrame, columns: Sequence[str] | None = None, top: int = fixed.TOP_ROWS) -> DataFrame:
    """Columns by missing cells, most first, header order on ties."""
    columns = list(columns if columns is not None else feature_columns(df))
    counts = df.agg(
        F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.lit(i).alias("position"), F.count_if(is_missing(df, c)).alias("missing"))
                for i, c in enumerate(columns)
            ]
        ).alias("c")
    )
    return counts.select(F.inline("c")).orderBy(F.desc("missing"), "position").limit(top)


def diagnose(df: DataFrame, target: str | None = None, mode: str = "auto") -> DataFrame:
    """One row `(problem_type, rationale)`: clustering, classification or regression."""
    if mode == "supervised" and not target:
        raise ValueError("Choose a target column for supervised learning.")
    if mode == "unsupervised" or not target:
        return df.sparkSession.range(1).select(
            F.lit("unsupervised").alias("problem_type"), F.lit(fixed.WHY_UNSUPERVISED).alias("rationale")
        )
    number, missing = as_number(df, target), is_missing(df, target)
    typed = F.lit(is_numeric_type(df.schema[target].dataType))
    # Copies are counted per value first; the test per value is then cheap and skew-free.
    values = df.select(number.alias("v"), missing.alias("m")).groupBy("v", "m").agg(F.count(F.lit(1)).alias("n"))
    facts = values.agg(
        F.coalesce(F.sum(F.when(~F.col("m"), F.col("n"))), F.lit(0)).alias("present"),
        F.coalesce(F.sum(F.when(F.col("v").isNotNull(), F.col("n"))), F.lit(0)).alias("parsed"),
        F.count_if(F.col("v").isNotNull()).alias("distinct"),
        F.coalesce(F.bool_and(F.abs(F.col("v") - F.round("v")) < fixed.INTEGER_TOLERANCE), F.lit(True)).alias("whole"),
    )
    ratio = F.when(F.col("present") == 0, F.lit(0.0)).otherwise(F.col("parsed") / F.col("present"))
    numeric = typed | (ratio >= fixed.NUMERIC_RATIO)
    limit = F.greatest(F.lit(fixed.CLASS_MIN), F.least(F.lit(fixed.CLASS_MAX), F.floor(F.col("parsed") * fixed.CLASS_SHARE)))
    few = F.col("whole") & (F.col("distinct") <= limit)
    head, tail = fixed.WHY_FEW_VALUES.format(target=target, n="{n}").split("{n}")
    return facts.select(
        F.when(numeric & ~few, "regression").otherwise("classification").alias("problem_type"),
        F.when(~numeric, fixed.WHY_LABELS.format(target=target))
        .when(few, F.concat(F.lit(head), F.col("distinct").cast("string"), F.lit(tail)))
        .otherwise(fixed.WHY_MANY_VALUES.format(target=target))
        .alias("rationale"),
    )


def class_counts(df: DataFrame, target: str) -> DataFrame:
    """`(label, n)` over non-missing target values, most frequent first, label order on ties."""
    return (
        df.where(~is_missing(df, target))
        .groupBy(as_text_label(df, target).alias("label"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "label")
    )


def first_seen_counts(df: DataFrame, column: str, key: str = ROW_ID) -> DataFrame:
    """As `class_counts`, ties in order of first appearance."""
    return (
        df.where(~is_missing(df, column))
        .groupBy(as_text_label(df, column).alias("label"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(col(key)).alias("first_row"))
        .orderBy(F.desc("n"), "first_row")
    )


def as_text_label(df: DataFrame, target: str) -> Column:
    """Label text; whole numbers of floating types are written without a fraction."""
    dtype = df.schema[target].dataType.typeName()
    if dtype in ("double", "float"):
        number = col(target).cast("double")
        return F.when(number == F.floor(number), F.floor(number).cast("string")).otherwise(number.cast("string"))
    return as_text(df, target) if dtype == "string" else col(target).cast("string")


def target_summary(df: DataFrame, target: str | None, problem_type: str) -> DataFrame:
    """Classes with counts, or the numeric target values, of the usable rows."""
    if not target or problem_type == "unsupervised":
        return df.sparkSession.createDataFrame([], "label string, n bigint")
    usable = usable_rows(df, target, problem_type)
    if problem_type == "regression":
        return usable.select(as_number(usable, target).alias("value"))
    return class_counts(usable, target)


def target_caption(df: DataFrame, target: str | None, problem_type: str) -> str:
    if not target or problem_type == "unsupervised":
        return fixed.TARGET_CAPTIONS["unsupervised"]
    return fixed.TARGET_CAPTIONS[problem_type].format(n=target_summary(df, target, problem_type).count())


def histogram(df: DataFrame, column: str, max_bins: int = fixed.MAX_BINS) -> DataFrame:
    """`(bin, bin_start, bin_end, n)`: equal-width bins, empty ones kept; one bin when all values are equal."""
    values = df.select(as_number(df, column).alias("v")).where(F.col("v").isNotNull())
    stats = values.agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count("v").alias("n")).first()
    spark = df.sparkSession
    if stats["n"] == 0:
        return spark.createDataFrame([], "bin bigint, bin_start double, bin_end double, n bigint")
    low, high, n = stats["low"], stats["high"], stats["n"]
    if low == high:
        return spark.createDataFrame([(0, low, high, n)], "bin bigint, bin_start double, bin_end double, n bigint")
    bins = min(max_bins, max(fixed.MIN_BINS, _ceil_sqrt(n)))
    index = F.least(F.lit(bins - 1), F.floor((F.col("v") - low) / F.lit(high - low) * bins))
    counts = values.groupBy(index.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    width = (high - low) / bins
    return (
        spark.range(bins).select(F.col("id").alias("bin"))
        .join(counts, "bin", "left")
        .select(
            "bin",
            (F.lit(low) + F.lit(width) * F.col("bin")).alias("bin_start"),
            (F.lit(low) + F.lit(width) * (F.col("bin") + 1)).alias("bin_end"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
    )


def _ceil_sqrt(n: int) -> int:
    from math import isqrt

    root = isqrt(n)
    return root if root * root == n else root + 1


def quartiles(df: DataFrame, columns: Sequence[str], method: str = "exact", accuracy: int = 10_000) -> DataFrame:
    """`(column, q1, median, q3)`.

    The exact mode interpolates at (n - 1) * q. `approx` takes one pass with mergeable sketches of
    bounded size and returns values of the column near those positions.
    """
    points = [0.25, 0.5, 0.75]
    # Text is parsed once per row here, whatever number of aggregates use the result.
    df = df.select(*[as_number(df, c).alias(c) for c in columns])
    if method == "approx":
        sketches = df.agg(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.percentile_approx(col(c), points, accuracy).alias("quantiles"))
                    for c in columns
                ]
            ).alias("s")
        )
        result = sketches.select(F.inline("s")).where(F.col("quantiles").isNotNull())
    else:
        result = exact_quantiles(df, {c: col(c) for c in columns}, points)
    q = F.col("quantiles")
    return result.select("column", q[0].alias("q1"), q[1].alias("median"), q[2].alias("q3"))


def moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`(column, mean, std)`: mean and population standard deviation, 0 when empty."""
    stats = df.select(*[as_number(df, c).alias(c) for c in columns]).agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    F.coalesce(F.avg(col(c)), F.lit(0.0)).alias("mean"),
                    F.coalesce(F.stddev_pop(col(c)), F.lit(0.0)).alias("std"),
                )
                for c in columns
            ]
        ).alias("s")
    )
    return stats.select(F.inline("s"))


def min_max_scaled(df: DataFrame, column: str, output: str) -> DataFrame:
    """Add `(v - min) / (max - min)`, 0.5 when all values are equal."""
    number = as_number(df, column)
    low, high = df.select(number.alias("v")).agg(F.min("v"), F.max("v")).first()
    if low is None or low == high:
        return df.withColumn(output, F.when(number.isNotNull(), F.lit(0.5)))
    return df.withColumn(output, (number - F.lit(low)) / F.lit(high - low))


