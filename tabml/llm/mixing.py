"""Mixing sources to target weights as a min-cost flow.

A document may belong to several sources. Documents with the same set of sources form a membership pattern; Spark sums
the words per pattern. Words flow from patterns to the quotas of their sources. Each further repetition of a pattern's
words costs more (convex), so every document is used once before any is used twice. The flow fixes how many words of each pattern
the mix takes; whole documents are then picked in the order of a seeded hash, by a boundary found from block sums
(`prefix.py`), so no document list reaches the driver.

Targets: each source's share of all words by weight, at most `most` times its size; the excess goes to the other
sources by weight until none is above. Only sizes per source and per pattern reach the driver; more than `MOST_PATTERNS`
patterns are refused. That bound is also that of the broadcast table of patterns.

Defined results: NULL and empty texts have no words and are never taken. A NULL source is a source of its own; an empty
member list is a pattern without a source and is not taken. Rows with equal keys and texts are taken together. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabml.llm.prefix import PrefixSums
from tabml.sources.scratch import stored

HASH_BITS, MOST_PATTERNS = 44, 100_000
WHITE = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WHITE)), F.lit(0)).cast("long")


def targets(sizes: dict, weights: dict, share: Fraction = Fraction(1), most: int = 3) -> dict:
    """Words wanted of each source: shares by weight of `share` of all words, each at most `most` times its size."""
    room = share * sum(sizes.values())
    # With a common level t, source s gets min(most * size, t * weight): those that fill up first have the least size for their weight.
    order = sorted((s for s in sizes if weights[s] > 0), key=lambda s: Fraction(sizes[s], 1) / weights[s])
    left, out = sum((Fraction(weights[s]) for s in order), Fraction(0)), {s: Fraction(0) for s in sizes}
    for s in order:
        out[s] = min(Fraction(most * sizes[s]), room * weights[s] / left)
        room, left = room - out[s], left - weights[s]
    return {s: float(v) for s, v in out.items()}


@dataclass
class _Edge:
    to: int
    room: int
    cost: int
    back: int


class Network:
    """Smallest-cost largest flow by shortest augmenting paths; whole numbers throughout."""

    def __init__(self, nodes: int):
        self.edges: list[list[_Edge]] = [[] for _ in range(nodes)]

    def link(self, a: int, b: int, room: int, cost: int) -> _Edge:
        there, here = _Edge(b, room, cost, len(self.edges[b])), _Edge(a, 0, -cost, len(self.edges[a]))
        self.edges[a].append(there)
        self.edges[b].append(here)
        return there

    def run(self, start: int, end: int) -> None:
        while True:
            cost, came, queue, waiting = {start: 0}, {}, deque([start]), {start}
            while queue:
                a = queue.popleft()
                waiting.discard(a)
                for e in self.edges[a]:
                    if e.room > 0 and cost[a] + e.cost < cost.get(e.to, 1 << 62):
                        cost[e.to], came[e.to] = cost[a] + e.cost, (a, e)
                        if e.to not in waiting:
                            waiting.add(e.to)
                            queue.append(e.to)
            if end not in cost:
                return
            path, at = [], end
            while at != start:
                a, e = came[at]
                path.append(e)
                at = a
            pushed = min(e.room for e in path)
            for e in path:
                e.room -= pushed
                self.edges[e.to][e.back].room += pushed


def flow(capacity: dict[tuple, int], quota: dict, most: int) -> dict[tuple, dict]:
    """Words that each pattern (a tuple of sources) gives to each of its sources; at most `most` times its capacity."""
    patterns, sources = list(capacity), list(quota)
    at = {s: 1 + len(patterns) + i for i, s in enumerate(sources)}
    end = 1 + len(patterns) + len(sources)
    net, used = Network(end + 1), {}
    for i, p in enumerate(patterns):
        for turn in range(most):
            net.link(0, 1 + i, capacity[p], turn * turn)
        used[p] = {s: net.link(1 + i, at[s], most * capacity[p], 0) for s in p if s in at}
    for s in sources:
        net.link(at[s], end, quota[s], 0)
    net.run(0, end)
    return {p: {s: most * capacity[p] - e.room for s, e in used[p].items()} for p in patterns}


@dataclass
class Mix:
    rows: DataFrame  # row, size, source_size, target, taken
    plan: dict  # words per pattern and source
    targets: dict


def mixed(
    df: DataFrame,
    members: Column,
    weights,
    size: Column,
    key: list[str],
    carry: list[str] | None = None,
    share: Fraction = Fraction(1),
    most: int = 3,
    seed: int = 0,
) -> Mix:
    """Decide for each row how many of its words the mix takes (`taken`, a multiple of its size).

    `members`: array of source names, which may hold NULL; `weights`: a function from the sorted source names to a dict of weights; `key`: columns
    that, hashed with the seed, give the order in which documents are picked. `source_size` and `target` are those of
    the first member.
    """
    spark = df.sparkSession
    carried = [F.col(f"`{c}`") for c in (df.columns if carry is None else carry)]
    drawn = F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.col(f"`{c}`").cast("string") for c in key)))
    rank = F.conv(F.substring(drawn, 1, HASH_BITS // 4), 16, 10).cast("long")
    rows = df.select(F.struct(*carried).alias("row"), F.array_sort(F.array_distinct(members)).alias("pattern"), size.alias("size"), rank.alias("rank"))
    slim = stored(rows.select("pattern", "size", "rank"), "sizes")
    found = slim.groupBy("pattern").agg(F.sum("size").alias("size")).limit(MOST_PATTERNS + 1).collect()
    if len(found) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} membership patterns")
    capacity = {tuple(r["pattern"] or ()): r["size"] for r in found}
    sizes: dict = {}
    for p, n in capacity.items():
        for s in p:
            sizes[s] = sizes.get(s, 0) + n
    ordered = sorted(sizes, key=lambda s: (s is None, s or ""))
    wanted = targets(sizes, weights(ordered), share, most)
    plan = flow(capacity, {s: round(t) for s, t in wanted.items()}, most)

    patterns = sorted(capacity, key=repr)
    schema = "at long, pattern array<string>, times long, cut long, source_size long, target double"
    numbered = spark.createDataFrame([(i, list(p), 0, 0, 0, 0.0) for i, p in enumerate(patterns)], schema)
    same = F.to_json(F.struct("pattern"), {"ignoreNullFields": "false"})
    placed = slim.withColumn("p", same).join(F.broadcast(numbered.select("at", same.alias("p"))), "p")
    spots = stored(placed.groupBy(F.shiftleft("at", HASH_BITS).bitwiseOR(F.col("rank")).alias("q")).agg(F.sum("size").alias("size")), "spots")
    sums = PrefixSums(spots, top_shift=HASH_BITS - 8)

    def picks(s: PrefixSums) -> list[tuple]:
        out, begin = [], 0
        for i, p in enumerate(patterns):
            n, words = capacity[p], sum(plan[p].values())
            times, rest = divmod(words, n) if n else (0, 0)
            low, high = s.boundary(begin + rest), s.following(begin + rest)
            end, block = low if begin + rest - low[0] <= high[0] - begin - rest else high
            q = s.first_q(block) if end > begin else i << HASH_BITS
            cut = min((1 << HASH_BITS) if q is None else q - (i << HASH_BITS), 1 << HASH_BITS)
            first = p[0] if p else None
            out.append((i, list(p), times, max(0, cut) if times < most else 0, sizes[first] if p else 0, wanted[first] if p else 0.0))
            begin += n
        return out

    table = spark.createDataFrame(sums.search(picks), schema).withColumn("p", same).drop("pattern", "at")
    joined = rows.withColumn("p", same).join(F.broadcast(table), "p", "left")
    taken = F.col("size") * (F.col("times") + (F.col("rank") < F.col("cut")).cast("long"))
    return Mix(joined.select("row", "size", "source_size", "target", taken.alias("taken")), plan, wanted)
