"""URL filter: rules on hosts and paths, and a character model ratio for URLs that no rule judges.

Two variable-order Markov models over bytes, of accepted and of rejected URLs, mix the counts of all contexts of up to `ORDER`
bytes (Witten-Bell: the share of a context's own counts grows with its count against its number of different successors).
A URL's ratio is the difference of the two log-likelihoods per byte, its end counted. URLs with a ratio of at least a
threshold are allowed; the threshold is calibrated on labelled URLs held back from the models: the middle of the widest
gap with the best mean of both classes' hit rates.

The models learn from all distinct URLs of both classes but those held back, a fifth by hash, all of which calibrate. Tasks count windows of
`ORDER` bytes and the next one; shorter contexts are their sums. Up to `SMALL` different windows go to every task as one model. With more, the
model stays a table: each different window of the URLs gets its value by joins, level by level, and a URL sums those of its windows.

Defined results: a NULL URL is an empty one, without host and path, and is judged by the models like any other. Without examples
of either class the threshold is 0 and the ratio is 0: such URLs are allowed. Repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabml.llm.tokens import pieces
from tabml.operators.ordering import SMALL_ROWS, running_totals
from tabml.sources.scratch import checkpointed

# Windows and held back ratios up to which they are held in one place; windows of many URLs that go to every task in any case.
SMALL, HOT = 1_000_000, 65_536
ORDER, HELD = 5, 5
# Values of windows are summed as whole numbers of this fraction, so the order of sums doesn't matter.
UNIT = 1 << 32
END, FIRST = 256, 257
SIZE = 258
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What stands between the first `://` and the next `/`, `?`, `#` or end, A-Z lower-cased; empty without `://`."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: dict[str, str]) -> tuple[Column, Column]:
    """The longest rule that fits (NULL if none), and its verdict. A rule `host/path` fits its host and subdomains and paths with its beginning."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r), r)):
        at = r.index("/")
        fits = ((host == r[:at]) | host.endswith("." + r[:at])) & path.startswith(r[at:])
        rule, verdict = F.when(fits, F.lit(r)).otherwise(rule), F.when(fits, F.lit(rules[r])).otherwise(verdict)
    return rule, verdict


def symbols(urls: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all URLs with an end each, and the URL of each."""
    raw = [np.frombuffer(u.encode("utf-8", "surrogatepass"), np.uint8) for u in (x or "" for x in urls.to_pylist())]
    sizes = np.array([len(r) + 1 for r in raw], np.int64)
    out = np.full(sizes.sum(), END, np.int64)
    keep = np.ones(len(out), bool)
    keep[np.cumsum(sizes) - 1] = False
    if keep.any():
        out[keep] = np.concatenate(raw)
    return out, np.repeat(np.arange(len(raw)), sizes)


def context_codes(symbol: np.ndarray, url: np.ndarray, order: int) -> Iterator[np.ndarray]:
    """For 0 to `order` symbols before each symbol: one number for them; what lies before the beginning is a symbol of its own."""
    code = np.zeros(len(symbol), np.int64)
    yield code
    for k in range(1, order + 1):
        before = np.full(len(symbol), FIRST, np.int64)
        before[k:] = np.where(url[k:] == url[:-k], symbol[:-k], FIRST)
        code = code + before * SIZE ** (k - 1)
        yield code


def windows(urls: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of each symbol with the `order` symbols before it, and the URL of each; modulo powers of `SIZE` it is that of fewer symbols."""
    symbol, url = symbols(urls)
    *_, code = context_codes(symbol, url, order)
    return code * SIZE + symbol, url


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(wanted))
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return np.where(keys[at] == wanted, values[at], 0.0)


@dataclass
class Markov:
    """Per order: contexts with their counts and numbers of different successors, and successors with their counts."""

    levels: list[tuple[np.ndarray, ...]]

    @staticmethod
    def of(urls: pa.Array, order: int = ORDER) -> Markov:
        return Markov.counted(*np.unique(windows(urls, order)[0], return_counts=True), order)

    @staticmethod
    def counted(window: np.ndarray, n: np.ndarray, order: int = ORDER) -> Markov:
        """From different windows with their counts."""
        levels = []
        for k in range(order + 1):
            pair, at = np.unique(window % SIZE ** (k + 1), return_inverse=True)
            count = np.bincount(at, n, len(pair))
            context, at = np.unique(pair // SIZE, return_inverse=True)
            levels.append((context, np.bincount(at, count, len(context)), np.bincount(at, minlength=len(context)).astype(float), pair, count))
        return Markov(levels)

    def mean_log(self, urls: pa.Array) -> np.ndarray:
        """Log-likelihood of each URL divided by its bytes and end."""
        symbol, url = symbols(urls)
        p = np.full(len(symbol), 1 / (SIZE - 1))
        for code, (context, n, different, pair, count) in zip(context_codes(symbol, url, len(self.levels) - 1), self.levels, strict=True):
            total, kinds = _lookup(context, n, code), _lookup(context, different, code)
            own = _lookup(pair, count, code * SIZE + symbol)
            p = np.where(total > 0, (own + kinds * p) / np.maximum(total + kinds, 1), p)
        return np.bincount(url, np.log(p), len(urls)) / np.bincount(url, minlength=len(urls))


@dataclass
class Ratio:
    accepted: Markov
    rejected: Markov
    threshold: float = 0.0

    def of(self, urls: pa.Array) -> np.ndarray:
        return self.accepted.mean_log(urls) - self.rejected.mean_log(urls)


def calibrated(good: np.ndarray, bad: np.ndarray) -> float:
    """The threshold with the best mean of the two hit rates; of equal ones the middle of the widest gap; 0 without both classes."""
    if not len(good) or not len(bad):
        return 0.0
    edges = np.unique(np.concatenate([good, bad]))
    middle = (edges[1:] + edges[:-1]) / 2 if len(edges) > 1 else edges
    good, bad = np.sort(good), np.sort(bad)
    rate = (len(good) - np.searchsorted(good, middle)) / len(good) + np.searchsorted(bad, middle) / len(bad)
    width = np.diff(edges) if len(edges) > 1 else np.zeros(1)
    return float(middle[np.lexsort((-width, -rate))[0]])


@dataclass
class RatioTable:
    """Counts of windows `(code, a, r)` of accepted and rejected URLs, too many for a task."""

    counts: DataFrame
    threshold: float = 0.0


def fitted(df: DataFrame, url: Column, verdict: Column, small: int = SMALL) -> Ratio | RatioTable:
    """Models of the distinct URLs whose `verdict` is `allow` and `block`; every fifth, by hash, calibrates."""
    known = df.where(verdict.isin("allow", "block")).select(url.alias("url"), (verdict == "allow").alias("good")).where("url is not null").distinct()
    known = checkpointed(known.withColumn("held", F.pmod(F.xxhash64("url"), F.lit(HELD)) == 0))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column(0), 1 << 20, 1 << 15):
                part = batch.slice(a, b - a)
                code, at = windows(part.column(0), ORDER)
                good = part.column(1).to_numpy(zero_copy_only=False).astype(bool)[at]
                code, place = np.unique(code, return_inverse=True)
                n = [np.bincount(place, kind, len(code)).astype(np.int64) for kind in (good, ~good)]
                yield pa.RecordBatch.from_arrays([pa.array(code), *map(pa.array, n)], ["code", "a", "r"])

    counts = known.where("NOT held").select("url", "good").mapInArrow(count, "code long, a long, r long")
    counts = checkpointed(counts.groupBy("code").agg(F.sum("a").alias("a"), F.sum("r").alias("r")))
    size = counts.agg(F.count(F.lit(1)), F.sum("a"), F.sum("r")).first()
    if not size[1] or not size[2]:
        none = Markov.of(pa.array([], pa.string()))
        return Ratio(none, none)
    if size[0] <= small:
        held = counts.toArrow()
        code, a, r = (held.column(c).to_numpy() for c in ("code", "a", "r"))
        model = Ratio(*(Markov.counted(code[n > 0], n[n > 0]) for n in (a, r)))
    else:
        model = RatioTable(counts)
    model.threshold = threshold_of(scored(known.where("held").select("url", "good"), model).select("good", "ratio"), small)
    return model


def threshold_of(held: DataFrame, small: int = SMALL) -> float:
    """`calibrated` on `(good, ratio)`; beyond `small` rows ratios are ranked over the cluster."""
    held = checkpointed(held.groupBy("ratio").agg(F.count_if("good").alias("a"), F.count_if(~F.col("good")).alias("r")))
    size = held.agg(F.count(F.lit(1)), F.sum("a"), F.sum("r")).first()
    if not size[1] or not size[2]:
        return 0.0
    if size[1] + size[2] <= small:
        rows = held.toArrow()
        ratio, a, r = (rows.column(c).to_numpy() for c in ("ratio", "a", "r"))
        return calibrated(np.repeat(ratio, a), np.repeat(ratio, r))
    if size[0] == 1:
        return float(held.first()["ratio"])
    ranked = checkpointed(running_totals(held, [], ["ratio"], {"place": F.lit(1).cast("bigint"), "below_a": F.col("a"), "below_r": F.col("r")}, min(small, SMALL_ROWS)))
    rate = (F.lit(size[1]) - F.col("below_a")) / F.lit(float(size[1])) + F.col("below_r") / F.lit(float(size[2]))
    rated = ranked.where(F.col("place") < size[0]).select("place", "ratio", rate.alias("rate"))
    best = rated.where(F.col("rate") == rated.agg(F.max("rate")).first()[0])
    following = ranked.select((F.col("place") - 1).alias("place"), F.col("ratio").alias("following"))
    row = best.join(following, "place").orderBy(F.desc(F.col("following") - F.col("ratio")), "place").first()
    return float((row["ratio"] + row["following"]) / 2)


def scored(rows: DataFrame, model: Ratio | RatioTable) -> DataFrame:
    """`rows` with their `ratio`, from their column `url`."""
    if isinstance(model, RatioTable):
        return _scored_by_tables(rows, model.counts)
    sent, at = rows.sparkSession.sparkContext.broadcast(model), rows.columns.index("url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column(at), 1 << 18, 4096):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(sent.value.of(part.column(at)))], [*part.schema.names, "ratio"])

    return rows.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", ratio double")


def _scored_by_tables(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Distinct URLs are cut into windows; values of windows found most often are summed in the tasks, those of the others joined."""
    links = checkpointed(rows.select(F.coalesce("url", F.lit("")).alias("link")).distinct().withColumn("id", F.monotonically_increasing_id()))
    empty = rows.sparkSession.sparkContext.broadcast((np.zeros(0, np.int64), np.zeros(0)))
    values = checkpointed(_values(_cut(links, empty).groupBy("code").agg(F.sum("n").alias("n")), counts))
    hot = values.orderBy(F.desc("n"), "code").limit(HOT).toPandas().sort_values("code")
    sent = rows.sparkSession.sparkContext.broadcast((hot["code"].to_numpy(), hot["value"].to_numpy()))
    each = checkpointed(_cut(links, sent))
    rare = each.where("code >= 0").select("id", "code", "n").join(values.select("code", "value"), "code").select("id", "n", (F.col("n") * F.col("value")).alias("value"))
    total = each.where("code < 0").select("id", "n", "value").unionByName(rare).groupBy("id").agg((F.sum("value") / F.lit(float(UNIT)) / F.sum("n")).alias("ratio"))
    found = links.join(total, "id").select("link", "ratio")
    return rows.join(found, F.coalesce(rows["url"], F.lit("")) == found["link"]).drop("link")


def _cut(links: DataFrame, sent) -> DataFrame:
    """`(id, code, n, value)` per URL and different window; windows of `sent` values together in a row of code -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, value = sent.value
        for batch in batches:
            for a, b in pieces(batch.column(0), 1 << 18, 4096):
                part = batch.slice(a, b - a)
                code, url = windows(part.column(0), ORDER)
                order = np.lexsort((code, url))
                code, url = code[order], url[order]
                first = np.flatnonzero(np.append(True, (np.diff(code) != 0) | (np.diff(url) != 0)))
                n = np.diff(np.append(first, len(code)))
                code, url = code[first], url[first]
                held = np.isin(code, known)
                worth = np.zeros(len(code), np.int64)
                worth[held] = n[held] * value[np.searchsorted(known, code[held])].astype(np.int64)
                sums, many = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
                np.add.at(sums, url[held], worth[held])
                np.add.at(many, url[held], n[held])
                met, ids = np.flatnonzero(many), part.column(1).to_numpy()
                columns = (np.append(ids[met], ids[url[~held]]), np.append(np.full(len(met), -1), code[~held]), np.append(many[met], n[~held]), np.append(sums[met], worth[~held]))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["id", "code", "n", "value"])

    return links.select("link", "id").mapInArrow(run, "id long, code long, n long, value long")


def _values(asked: DataFrame, counts: DataFrame) -> DataFrame:
    """`(code, n, value)`: difference of the logarithms of both models for each asked window, in `UNIT`."""
    found = asked.withColumn("p_a", F.lit(1 / (SIZE - 1))).withColumn("p_r", F.lit(1 / (SIZE - 1)))
    for k in range(ORDER + 1):
        size = SIZE ** (k + 1)
        own = counts.groupBy((F.col("code") % F.lit(size)).alias("pair")).agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
        context = own.groupBy(F.expr(f"pair div {SIZE}").alias("context")).agg(
            *[x for c in "ar" for x in (F.sum(c).alias(f"n_{c}"), F.count_if(F.col(c) > 0).alias(f"kinds_{c}"))]
        )
        if k < 2:  # at most the square of the symbols
            own, context = F.broadcast(own), F.broadcast(context)
        found = found.withColumn("pair", F.col("code") % F.lit(size)).withColumn("context", F.expr(f"pair div {SIZE}"))
        found = found.join(own, "pair", "left").join(context, "context", "left")
        for c in "ar":
            mixed = (F.coalesce(c, F.lit(0)) + F.col(f"kinds_{c}") * F.col(f"p_{c}")) / (F.col(f"n_{c}") + F.col(f"kinds_{c}"))
            found = found.withColumn(f"p_{c}", F.when(F.col(f"n_{c}") > 0, mixed).otherwise(F.col(f"p_{c}")))
        found = found.select("code", "n", "p_a", "p_r")
    return found.select("code", "n", F.round((F.log("p_a") - F.log("p_r")) * F.lit(float(UNIT))).cast("long").alias("value"))


def judged(df: DataFrame, rules: dict[str, str], url: str = "url", carry: list[str] | None = None, small: int = SMALL) -> DataFrame:
    """`(row, host, path, rule, ratio, verdict)` for each row; `row` holds the columns `carry` (all by default)."""
    link = F.col(f"`{url}`")
    ruled = rule_for(host_of(link), path_of(link), rules)[1]
    ratio = fitted(df, link, ruled, small)
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in (df.columns if carry is None else carry))).alias("row"), link.alias("url"))
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    by_model = F.when(F.col("ratio") >= ratio.threshold, F.lit("allow")).otherwise(F.lit("block"))
    placed = scored(rows, ratio).select("row", host.alias("host"), path.alias("path"), "ratio")
    return placed.select("row", "host", "path", rule.alias("rule"), "ratio", F.coalesce(verdict, by_model).alias("verdict"))
