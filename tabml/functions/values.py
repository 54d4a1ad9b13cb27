"""Column expressions for raw cell values: missing test, number parsing, text.

All of them are built-in Spark expressions, so they stay in whole-stage codegen and can be
pushed through projections.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabml.functions import fixed

# Every character counted as white space when a cell is trimmed.
WHITE_SPACE = "".join(
    map(chr, [9, 10, 11, 12, 13, 32, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF])
)
_RADIX = {"0x": 16, "0b": 2, "0o": 8}


def quoted(name: str) -> str:
    """Column name safe for `F.col`, also with dots or back-ticks in it."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE))


def is_missing_text(text: Column) -> Column:
    """NULL or one of the missing tokens."""
    return text.isNull() | F.lower(trimmed(text)).isin(*fixed.MISSING_TOKENS)


def text_to_number(text: Column) -> Column:
    """Double read from text, NULL when missing, malformed or not finite.

    Currency signs, thousands separators and percent signs are dropped first. The alphabet check
    keeps Spark's own spellings (`1d`, `NaN`, `Infinity`) from being read as numbers; it also rejects
    every missing token.
    """
    cleaned = trimmed(F.translate(text, fixed.NUMBER_NOISE, ""))
    number = F.when(F.translate(cleaned, "0123456789+-.eE", "") == "", cleaned.try_cast("double")).when(
        F.lower(F.substr(cleaned, F.lit(1), F.lit(2))).isin(*_RADIX), _radix_number(F.lower(cleaned))
    )
    # `nullif` computes the number once; the comparison in `finite` would parse the text twice.
    infinity = F.lit(float("inf"))
    return F.nullif(F.nullif(number, infinity), -infinity)


def _radix_number(text: Column) -> Column:
    """`0x1f`, `0b101` and `0o17` as doubles, NULL when a digit does not belong to the base."""
    base = F.create_map(*[F.lit(v) for pair in _RADIX.items() for v in pair])[F.substr(text, F.lit(1), F.lit(2))]
    body = F.substr(text, F.lit(3))
    places = F.transform(F.split(body, ""), lambda digit: F.instr(F.lit("0123456789abcdef"), digit) - 1)
    valid = (body != "") & F.forall(places, lambda p: (p >= 0) & (p < base))
    return F.when(valid, F.aggregate(places, F.lit(0.0), lambda total, p: total * base + p))


def finite(number: Column) -> Column:
    """The number itself, NULL for NaN and the infinities."""
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def is_numeric_type(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def as_text(df: DataFrame, name: str) -> Column:
    """Trimmed text of a cell, NULL when missing. Booleans and dates become their text, whole numbers and decimals exactly."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.IntegralType, T.DecimalType)):
        return col(name).cast("string")
    if is_numeric_type(dtype):
        return (finite(col(name).cast("double")) + F.lit(0.0)).cast("string")
    text = col(name).cast("string")
    return F.when(~is_missing_text(text), trimmed(text))


def as_number(df: DataFrame, name: str) -> Column:
    """Finite double of a cell, NULL otherwise."""
    if is_numeric_type(df.schema[name].dataType):
        return finite(col(name).cast("double"))
    return text_to_number(col(name).cast("string"))


def is_missing(df: DataFrame, name: str) -> Column:
    """Missing test for any column type; typed NaN and infinities count as missing."""
    if is_numeric_type(df.schema[name].dataType):
        return finite(col(name).cast("double")).isNull()
    return is_missing_text(col(name).cast("string"))


def clamp(value: Column, lower: float, upper: float) -> Column:
    """Limit to [lower, upper]; no limit when both are equal."""
    if lower == upper:
        return value
    return F.least(F.lit(float(upper)), F.greatest(F.lit(float(lower)), value))


def format_number(value: Column) -> Column:
    """Two decimals from 100 up, else three; of two equally near texts that of the larger size; trailing zeros are cut."""
    value = value + F.lit(0.0)  # no sign for zero

    def fixed_decimals(digits: int) -> Column:
        # Only an odd multiple of 2 ** -(digits + 1) lies halfway between two texts; the built-in rounds it to even.
        halves = F.abs(value) * float(2 ** (digits + 1))
        halfway = (halves < 2.0**52) & (halves % 2 == 1)
        up = F.signum(value) * (F.floor(F.abs(value) * 10**digits) + 1) / 10**digits
        text = F.regexp_replace(F.format_number(F.when(halfway, up).otherwise(value), digits), ",", "")
        return F.regexp_replace(text, r"\.?0+$", "")

    return (
        F.when(finite(value).isNull(), F.lit("-"))
        .when(F.abs(value) >= 100, fixed_decimals(2))
        .otherwise(fixed_decimals(3))
    )
