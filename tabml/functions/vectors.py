"""Expressions over `ARRAY<DOUBLE>` feature columns with fitted parameters as literals."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Up to this many features a sum is written out term by term and compiled by codegen;
# wider vectors use higher-order functions so that the generated code stays small.
UNROLL_LIMIT = 24
# Longer constant arrays are one JSON text that the optimizer folds; as SQL each value would be an expression to analyse.
FEW_VALUES = 64


def array_literal(values: Sequence) -> Column:
    """Constant array of doubles, or of arrays of doubles; handed over as one text, not value by value."""
    nested = len(values) > 0 and isinstance(values[0], Sequence)
    kind = "array<array<double>>" if nested else "array<double>"
    flat = [v for part in values for v in part] if nested else values
    if len(flat) > FEW_VALUES and all(math.isfinite(v) for v in flat):
        plain = [[float(v) for v in part] for part in values] if nested else [float(v) for v in values]
        return F.from_json(F.lit(json.dumps(plain)), kind)
    return F.expr(_array_text(values, lambda v: f"{float(v)!r}D")).cast(kind)


def index_literal(values: Sequence) -> Column:
    """Constant array of integers, or of arrays of integers."""
    nested = len(values) > 0 and isinstance(values[0], Sequence)
    kind = "array<array<int>>" if nested else "array<int>"
    if len(values) > FEW_VALUES:
        return F.from_json(F.lit(json.dumps([[int(v) for v in part] for part in values] if nested else [int(v) for v in values])), kind)
    return F.expr(_array_text(values, str)).cast(kind)


def _array_text(values: Sequence, item: Callable[..., str]) -> str:
    return "array(" + ",".join(_array_text(v, item) if isinstance(v, Sequence) else item(v) for v in values) + ")"


def _sum_terms(features: Column, term: Callable[..., Column], *params: Sequence[float]) -> Column:
    width = len(params[0])
    if width == 0:
        return F.lit(0.0)
    if width <= UNROLL_LIMIT:
        terms = [term(features[j], *[F.lit(float(p[j])) for p in params]) for j in range(width)]
        return reduce(lambda a, b: a + b, terms)
    packed = F.array(*[F.struct(*[F.lit(float(p[j])).alias(f"p{i}") for i, p in enumerate(params)]) for j in range(width)])
    values = F.zip_with(features, packed, lambda x, p: term(x, *[p[f"p{i}"] for i in range(len(params))]))
    return F.aggregate(values, F.lit(0.0), lambda total, value: total + value)


def dot(features: Column, weights: Sequence[float]) -> Column:
    return _sum_terms(features, lambda x, w: x * w, weights)


def squared_distance_to(features: Column, center: Sequence[float]) -> Column:
    return _sum_terms(features, lambda x, c: (x - c) * (x - c), center)


def gaussian_log_score(features: Column, prior: float, means: Sequence[float], variances: Sequence[float]) -> Column:
    """log prior plus the log density of independent normal features."""
    constant = float(np.log(prior)) - 0.5 * float(np.sum(np.log(2 * np.pi * np.asarray(variances))))
    halves = [0.5 / v for v in variances]
    return F.lit(constant) - _sum_terms(features, lambda x, m, h: (x - m) * (x - m) * h, means, halves)


def squared_distance(a: Column, b: Column) -> Column:
    """Squared distance of two array columns."""
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda total, value: total + value
    )


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def softmax(scores: Column) -> Column:
    """Shifted by the largest score; the sum is never zero. `scores` should be a plain column."""
    exps = bound(F.array_max(scores), lambda top: F.transform(scores, lambda s: F.exp(s - top)))
    return bound(exps, normalized)


def normalized(weights: Column) -> Column:
    total = F.aggregate(weights, F.lit(0.0), lambda a, b: a + b)
    divisor = F.when(total == 0, F.lit(1.0)).otherwise(total)
    return bound(divisor, lambda t: F.transform(weights, lambda w: w / t))


def argmax(values: Column) -> Column:
    """Zero-based position of the largest value, the first one on ties."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("double")


def argmin(values: Column) -> Column:
    return (F.array_position(values, F.array_min(values)) - 1).cast("double")
