"""Delimited text source: separator detection, unique headers, all-text columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabml.functions import fixed
from tabml.functions.values import WHITE_SPACE, col, trimmed

_QUOTING = {"quote": '"', "escape": '"'}


def detect_delimiter(spark: SparkSession, path: str) -> str:
    """The candidate that cuts the first non-blank line into most fields; earlier ones win ties."""
    line = F.col("value")
    candidates = [
        F.struct(F.size(F.split(line, "\\" + d if d == "|" else d)).alias("n"), F.lit(-rank).alias("r"), F.lit(d).alias("d"))
        for rank, d in enumerate(fixed.DELIMITERS)
    ]
    first_line = spark.read.text(path).where(trimmed(line) != "").limit(1)
    row = first_line.select(F.array_max(F.array(*candidates))["d"].alias("delimiter")).first()
    return row["delimiter"] if row else fixed.DELIMITERS[0]


def unique_headers(names: Sequence[str | None]) -> list[str]:
    """Blank names become `column_<position>`; repeats get the first free `_2`, `_3`, ... suffix.

    Names are compared without case because Spark resolves columns that way.
    """
    taken: set[str] = set()
    result = []
    for position, name in enumerate(names, start=1):
        base = (name or "").strip(WHITE_SPACE) or f"column_{position}"
        candidate, suffix = base, 2
        while candidate.lower() in taken:
            candidate, suffix = f"{base}_{suffix}", suffix + 1
        taken.add(candidate.lower())
        result.append(candidate)
    return result


def read_table(spark: SparkSession, path: str, sep: str | None = None, multiline: bool = True) -> DataFrame:
    """Read a delimited file as trimmed text columns.

    The first record with any text is the header; the first record of any other file of a folder is dropped
    only if it repeats the header. Blank records are dropped, short records are padded with empty text, extra
    fields are cut. Line breaks inside quotes need `multiline`, which
    reads each file in one task; pass `multiline=False` for large files without such breaks, so that
    Spark splits them over many tasks.
    """
    sep = sep or detect_delimiter(spark, path)

    def scan(header: bool, width: int | None) -> DataFrame:
        reader = spark.read.options(
            sep=sep, header=header, multiLine=multiline, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True, **_QUOTING
        )
        if width is not None:
            reader = reader.schema(T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)]))
        return reader.csv(path)

    place = ("_file", "_at")

    def cleaned(df: DataFrame) -> DataFrame:
        return df.select("*").withColumns({c: F.coalesce(trimmed(F.col(c)), F.lit("")) for c in df.columns if c not in place})

    def has_text(df: DataFrame) -> Column:
        return reduce(lambda a, b: a | b, [F.col(c) != "" for c in df.columns if c not in place])

    width = _header_width(spark, path, sep, len(scan(False, None).columns))
    # `_at` marks the place of a record in its file, to tell headers from equal data records.
    at = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    placed = cleaned(scan(False, width).select("*", F.col("_metadata.file_path").alias("_file"), at.alias("_at")))
    records = placed.where(has_text(placed))
    header, *more = records.take(2) or [None]
    if header is None or not more:
        raise ValueError(fixed.CSV_TOO_SHORT)
    names = unique_headers([header[f"_c{i}"] for i in range(width)])
    if len(placed.inputFiles()) == 1:
        if header["_at"]["id"] == 0:
            body = cleaned(scan(True, width))
            return body.where(has_text(body)).toDF(*names)
        return records.where(F.col("_at.id") != header["_at"]["id"]).drop(*place).toDF(*names)
    # One row per file, whose names the driver holds anyway.
    firsts = F.broadcast(records.groupBy("_file").agg(F.min("_at").alias("_first")))
    repeats = reduce(lambda a, b: a & b, [F.col(f"_c{i}") == F.lit(header[f"_c{i}"]) for i in range(width)])
    return records.join(firsts, "_file").where(~((F.col("_at") == F.col("_first")) & repeats)).drop(*place, "_first").toDF(*names)


def _header_width(spark: SparkSession, path: str, sep: str, scanned: int) -> int:
    """Fields of the first line with text: blank records before it may be narrower."""
    line = spark.read.text(path).where(F.translate(trimmed(F.col("value")), sep + '"' + WHITE_SPACE, "") != "").first()
    if line is None:
        raise ValueError(fixed.CSV_TOO_SHORT)
    parsed = spark.range(1).select(F.schema_of_csv(F.lit(line["value"]), {"sep": sep, **_QUOTING})).first()[0]
    return max(scanned, parsed.count(",") + 1)
