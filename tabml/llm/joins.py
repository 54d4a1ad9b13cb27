"""Joins of whole documents with a narrow table of keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A table of keys with at most so many rows, of two or three numbers each (some 50 MB in memory), may be broadcast.
MOST_KEYS = 1_000_000


def key_side(keys: DataFrame) -> DataFrame:
    """A materialised narrow table as the side of a join: broadcast if its counted rows are within the bound, else shuffled."""
    return F.broadcast(keys) if keys.count() <= MOST_KEYS else keys
