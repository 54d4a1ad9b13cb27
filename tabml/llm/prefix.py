"""Positions in a huge ordered sequence of sizes, found from block sums that are refined only where they are needed.

The rows `(q, size)` are ordered by the whole number `q`. The driver holds sums of blocks of `q` that share their
high bits. A search asks for the boundary at or before some running total; where the answer lies inside a block, the
block is noted, and after the search one Spark job sums the parts of all noted blocks. The search is repeated until
it meets no inner block, so its answers are exact. Each round keeps only sums of `2**step` parts per noted block.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Found = TypeVar("Found")


class PrefixSums:
    """`rows`: materialised rows with a whole number `q` >= 0 and its `size` >= 0; equal `q` are one item."""

    def __init__(self, rows: DataFrame, top_shift: int, step: int = 8):
        self.rows, self.step = rows, step
        self.noted: set[int] = set()
        self.blocks: list[tuple[int, int, int, bool]] = []  # first q, shift, size, whether it is a single item
        self._merge(set(), self._summed(None, top_shift, top_shift))

    @property
    def total(self) -> int:
        return self.ends[-1] if self.ends else 0

    def _summed(self, keys: list[int] | None, shift: int, finer: int) -> list[tuple[int, int, int, bool]]:
        rows = self.rows
        if keys is not None:
            rows = rows.where(F.shiftright("q", shift).isin(keys))
        parts = rows.groupBy(F.shiftright("q", finer).alias("k")).agg(F.sum("size").alias("s"), F.min("q").alias("a"), F.max("q").alias("b"))
        return [(r["a"] if r["a"] == r["b"] else r["k"] << finer, finer, r["s"], r["a"] == r["b"]) for r in parts.collect()]

    def _merge(self, gone: set[int], found: list[tuple[int, int, int, bool]]) -> None:
        self.blocks = sorted([b for i, b in enumerate(self.blocks) if i not in gone] + found)
        self.ends, run = [], 0
        for b in self.blocks:
            run += b[2]
            self.ends.append(run)

    def boundary(self, x: int) -> tuple[int, int]:
        """The largest running total at most `x` at the end of an item, and the index of the first block behind it."""
        at = bisect_right(self.ends, x)
        if at < len(self.blocks) and not self.blocks[at][3] and (self.ends[at - 1] if at else 0) < x:
            self.noted.add(at)
        return (self.ends[at - 1] if at else 0), at

    def following(self, x: int) -> tuple[int, int]:
        """The smallest running total at least `x` at the end of an item, and the index of the first block behind it."""
        end, at = self.boundary(x)
        return (end, at) if end == x or at >= len(self.blocks) else (self.ends[at], at + 1)

    def first_q(self, at: int) -> int | None:
        """The smallest `q` of block `at`; None behind the last block."""
        return self.blocks[at][0] if at < len(self.blocks) else None

    def search(self, function: Callable[[PrefixSums], Found]) -> Found:
        """The exact result of `function`, which asks by `boundary` and `following` alone."""
        while True:
            self.noted.clear()
            result = function(self)
            if not self.noted:
                return result
            near = {j for i in self.noted for j in (i - 1, i, i + 1) if 0 <= j < len(self.blocks) and not self.blocks[j][3]}
            found = []
            for shift in {self.blocks[i][1] for i in near}:
                keys = [self.blocks[i][0] >> shift for i in near if self.blocks[i][1] == shift]
                found += self._summed(keys, shift, max(0, shift - self.step))
            self._merge(near, found)
