"""Minimax contiguous sharding: the smallest shard capacity that suffices for ordered, indivisible groups.

Native: DataFrame functions only. Rows with equal texts are one group; groups are ordered by a 60-bit hash of the
text. The smallest feasible capacity is found by binary search, each capacity checked by filling shards greedily; the
running totals come from block sums (`prefix.py`), so the driver sees sums only. Among the cuts of that capacity, each
is set as near to the equal share as the capacity and the rest allow, so that no shard is left almost empty.

Slots number the rows of a shard without gaps: rows are dealt to buckets by hash, buckets are counted, and rows are
numbered within their bucket, so a hot text never meets in one task.

Defined results: a NULL text has no bytes and forms one group of its own; empty texts are another. Repeated rows are
placed one by one into the same shard. An empty table gives an empty result. Input columns travel in the struct column
`row`, so their names can't clash. Texts whose 60-bit hashes meet stay together, which is harmless.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabml.llm.prefix import PrefixSums
from tabml.sources.scratch import stored

BITS = 60
BUCKET_ROWS, LEAST_BUCKETS = 20_000, 8


def group_key(text: Column) -> Column:
    return F.when(text.isNull(), F.lit(0).cast("long")).otherwise(F.shiftrightunsigned(F.xxhash64(text), 64 - BITS))


def row_size(text: Column, overhead: int) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(overhead).cast("long")


def shards_needed(sums: PrefixSums, capacity: int, most: int) -> int:
    """Shards that greedy filling takes, or `most + 1` if more."""
    at, n = 0, 0
    while at < sums.total and n <= most:
        end, _ = sums.boundary(at + capacity)
        if end <= at:
            return most + 1
        at, n = end, n + 1
    return n


def smallest_capacity(sums: PrefixSums, shards: int) -> int:
    """The least capacity with which greedy filling takes at most `shards` shards."""
    low, high = max(1, -(-sums.total // shards)), max(1, sums.total)
    while low < high:
        middle = (low + high) // 2
        if shards_needed(sums, middle, shards) <= shards:
            high = middle
        else:
            low = middle + 1
    return low


def cuts_for(sums: PrefixSums, shards: int) -> tuple[int, list[int | None]]:
    """The capacity and the first `q` of each shard after the first; None: the shard is empty."""
    capacity = sums.search(lambda s: smallest_capacity(s, shards))

    def place(s: PrefixSums) -> list[int | None]:
        earliest = [s.total]  # from the end: where a shard may begin at the earliest
        for _ in range(shards - 1):
            earliest.append(s.following(max(0, earliest[-1] - capacity))[0])
        earliest.reverse()
        at, cuts = 0, []
        for j in range(1, shards):
            ideal = s.total * j // shards
            low, high = s.boundary(ideal), s.following(ideal)
            end, block = low if ideal - low[0] <= high[0] - ideal else high
            if end > at + capacity:
                end, block = s.boundary(at + capacity)
            if end < max(at, earliest[j - 1]):
                end, block = s.following(max(at, earliest[j - 1]))
            cuts.append(s.first_q(block))
            at = end
        return cuts

    return capacity, sums.search(place)


def sharded(df: DataFrame, shards: int, text: str = "text", overhead: int = 8, carry: list[str] | None = None, key: list[str] | None = None) -> DataFrame:
    """`(row, size, shard, slot)` for each input row; `row` holds the columns `carry` (all by default).

    `key`: columns by whose hash rows are dealt to buckets within their shard; all carried columns that can be hashed
    by default. `shards` may be some hundreds: the driver keeps block sums around every possible cut.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    rows = df.select(
        F.struct(*(F.col(f"`{c}`") for c in (df.columns if carry is None else carry))).alias("row"),
        F.xxhash64(*(F.col(f"`{c}`") for c in key or [text])).alias("h"),
        row_size(F.col(text), overhead).alias("size"),
        group_key(F.col(text)).alias("q"),
    )
    groups = stored(rows.groupBy("q").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")), "groups")
    n = groups.agg(F.sum("n")).first()[0] or 0
    _, cuts = cuts_for(PrefixSums(groups, top_shift=BITS - 12), shards)
    marks = [c for c in cuts if c is not None]
    shard = F.size(F.filter(F.array(*(F.lit(c).cast("long") for c in marks)), lambda c: c <= F.col("q"))) if marks else F.lit(0)
    buckets = max(LEAST_BUCKETS, -(-n // (shards * BUCKET_ROWS)))
    placed = rows.withColumn("shard", shard.cast("int")).withColumn("bucket", F.pmod(F.xxhash64("h", "q"), F.lit(buckets)).cast("int"))
    counts = stored(placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n")), "buckets")
    ahead = W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = stored(counts.select("shard", "bucket", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead")), "offsets")
    within = F.row_number().over(W.partitionBy("shard", "bucket").orderBy("h", "q"))
    numbered = placed.withColumn("within", within).join(offsets, ["shard", "bucket"], "left")
    return numbered.select("row", "size", "shard", (F.col("ahead") + F.col("within") - 1).cast("long").alias("slot"))
