"""Quality rules on hosts: rule failures counted per host, rates shrunk by an empirical beta prior, verdicts joined back.

Native: DataFrame functions only. Each text is measured once, within its row. Failures are summed per host with
partial sums in each task, so a host with a third of all rows sends one row per task. For each rule a beta prior is
fitted to all hosts by moments; the posterior mean of a host is its shrunk rate, so that a host with few documents is
judged like the average host.

The verdict follows the data. A host is *worse* than usual for a rule if its posterior mean lies more than `deviations` posterior
standard deviations above the mean of the fitted prior, *better* if it lies so far below. A failed rule has an excess: the measure
over its limit, more than 1. It is weighed by the tolerance of the document's host for this rule: `clear` on a usual host, one less on a
worse and one more on a better one; a host that is worse in base failures is worse for every rule. A document goes if it fails a base rule
itself, if its failed rules' excesses over their tolerances add up to more than 1, or if its host is blocked (shrunk rate of base
failures above `block_rate`). So any failure counts on a worse host, a clear one or several slight ones elsewhere. A document
that fails no rule stays on every host that isn't blocked.

Only hosts that aren't usual are joined back. Up to `MOST_KEYS` of them are broadcast. Beyond that those with more than that part of
all rows are (there can't be more of them), and the others, none of which is hot, meet their documents in a shuffle.

Defined results: a NULL or empty text has no words and fails the base rules. NULL hosts are one host. Repeated rows
are judged one by one, all alike. An empty table gives an empty result. The input's columns travel in one struct
column `row`, so their names can't clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabml.llm.joins import MOST_KEYS
from tabml.sources.scratch import stored

WHITE = " \t\n\x0b\f\r"
RULES = ("base", "symbols", "lines", "length")


@dataclass(frozen=True)
class Limits:
    min_words: int = 50
    repeat_percent: int = 50
    symbol_percent: int = 10
    line_percent: int = 30
    mean_chars: tuple[int, int] = (3, 12)
    clear: float = 2.0
    deviations: float = 2.0
    block_rate: float = 0.9


def bound_to(value: Column, body) -> Column:
    """`body` of a value that is computed once, however often the body's lambdas use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Words between white space; none for NULL."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[ \t-\r]+"))


def _repeated(ws: Column) -> Column:
    """Words covered by windows of three words that occur twice or more."""
    window = F.transform(
        F.sequence(F.lit(0), F.size(ws) - 3),
        lambda i: F.struct(F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)).alias("h"), i.alias("i")),
    )

    def same(rows: Column, x: Column, j: Column) -> Column:
        return F.coalesce(F.get(rows, j)["h"] == x["h"], F.lit(False))

    def covered(rows: Column) -> Column:
        twice = F.filter(rows, lambda x, j: same(rows, x, j - 1) | same(rows, x, j + 1))
        return bound_to(
            F.sort_array(F.transform(twice, lambda x: x["i"])),
            lambda at: F.aggregate(
                F.transform(at, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(at, j + 1) - x, F.lit(3)))), F.lit(0), lambda a, b: a + b
            ),
        )

    return F.when(F.size(ws) < 3, 0).otherwise(bound_to(F.sort_array(window), covered))


def measures(text: Column) -> Column:
    """Struct of the measures of a text: words, their code points, symbols, lines, repeated lines and words."""
    given = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(given, "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    return bound_to(
        words(text),
        lambda ws: F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.length(F.array_join(ws, "")).cast("long").alias("word_chars"),
            F.regexp_count(given, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            bound_to(lines, lambda ls: F.struct(F.size(ls).cast("long").alias("n"), (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("dup"))).alias("lines"),
            _repeated(ws).cast("long").alias("n_repeat_words"),
        ),
    )


def failures(q: Column, limits: Limits) -> dict[str, Column]:
    n = q["n_words"]
    return {
        "base": (n < limits.min_words) | (100 * q["n_repeat_words"] > limits.repeat_percent * n),
        "symbols": 100 * q["n_symbols"] > limits.symbol_percent * n,
        "lines": 100 * q["lines"]["dup"] > limits.line_percent * q["lines"]["n"],
        "length": (q["word_chars"] < limits.mean_chars[0] * n) | (q["word_chars"] > limits.mean_chars[1] * n),
    }


def excesses(q: Column, limits: Limits) -> dict[str, Column]:
    """The measure over its limit of each rule that isn't a base rule; only its values above 1 are used."""
    n = q["n_words"].cast("double")
    ratio = F.try_divide
    return {
        "symbols": ratio(100.0 * q["n_symbols"], limits.symbol_percent * n),
        "lines": ratio(100.0 * q["lines"]["dup"], limits.line_percent * q["lines"]["n"].cast("double")),
        "length": F.greatest(ratio(limits.mean_chars[0] * n, q["word_chars"].cast("double")), ratio(q["word_chars"].cast("double"), limits.mean_chars[1] * n)),
    }


def host_verdicts(measured: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """`(host, n, <rule>_rate ..., tolerance_<rule> ..., blocked)`; `measured` has `host` and booleans per rule in `fails`."""
    hosts = stored(
        measured.groupBy("host").agg(F.count(F.lit(1)).alias("n"), *(F.sum(F.col("fails")[r].cast("long")).alias(r) for r in RULES)), "hosts"
    )
    moments = hosts.agg(
        F.count(F.lit(1)).alias("hosts"),
        F.sum("n").alias("n"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"),
        *(F.sum(r).alias(r) for r in RULES),
        *(F.sum(F.col(r).cast("double") * F.col(r) / F.col("n")).alias(f"{r}_square") for r in RULES),
    ).first()
    rates, sides = {}, {}
    for r in RULES:
        mean, weight = prior(moments["hosts"], moments["n"] or 0, moments["nn"] or 0.0, moments[r] or 0, moments[f"{r}_square"] or 0.0)
        rate = (F.col(r) + F.lit(weight * mean)) / (F.col("n") + F.lit(weight))
        margin = limits.deviations * F.sqrt(F.greatest(rate * (1 - rate), F.lit(0.0)) / (F.col("n") + F.lit(weight + 1)))
        rates[r], sides[r] = rate, F.when(rate - margin > mean, 1.0).when(rate + margin < mean, -1.0).otherwise(0.0)
    worse = {r: F.when(sides["base"] > 0, 1.0).otherwise(sides[r]) for r in RULES[1:]}
    return hosts.select(
        "host",
        "n",
        *(rates[r].alias(f"{r}_rate") for r in RULES),
        *((limits.clear - worse[r]).alias(f"tolerance_{r}") for r in RULES[1:]),
        (rates["base"] > limits.block_rate).alias("blocked"),
    )


def prior(hosts: int, n: int, nn: float, k: int, square: float) -> tuple[float, float]:
    """Mean and weight (pseudo-documents) of the beta prior from all hosts' counts, by moments of the beta-binomial.

    `nn`: sum of squared host sizes; `k`: failures; `square`: sum of failures squared over host size. With equal or
    too few hosts the between-host variance vanishes and the prior outweighs every host (weight at most 1e6).
    """
    if not n:
        return 0.0, 1e6
    mean = k / n
    spread, room = mean * (1 - mean), n - nn / n - (hosts - 1)
    if spread <= 0 or room <= 0:
        return mean, 1e6
    between = (square - k * mean - spread * (hosts - 1)) / (spread * room)
    between = min(max(between, 1e-6), 0.999)
    return mean, 1 / between - 1


def _with_verdicts(measured: DataFrame, verdicts: DataFrame, usual: float, most: int) -> DataFrame:
    """`measured` with the tolerances and the block of its host; a host that isn't found is a usual one."""
    marks = [f"tolerance_{r}" for r in RULES[1:]]
    told = F.col("blocked")
    for c in marks:
        told = told | (F.col(c) != usual)
    unusual = verdicts.where(told).select(F.col("host").alias("its_host"), F.col("n").alias("host_rows"), *marks, "blocked")
    same = F.col("host").eqNullSafe(F.col("its_host"))
    if unusual.count() <= most:
        met = measured.join(F.broadcast(unusual), same, "left")
    else:
        rows = verdicts.agg(F.sum("n")).first()[0]
        large = F.col("host_rows") * most > rows
        hot, cold = unusual.where(large), unusual.where(~large)
        met = measured.join(F.broadcast(hot), same).unionByName(measured.join(F.broadcast(hot), same, "left_anti").join(cold, same, "left"))
    return met.withColumns({c: F.coalesce(c, F.lit(usual)) for c in marks} | {"blocked": F.coalesce("blocked", F.lit(False))})


def judged(
    df: DataFrame, text: str = "text", host: str = "source", carry: list[str] | None = None, limits: Limits = Limits(), most_keys: int = MOST_KEYS
) -> DataFrame:
    """`(row, q, base_failed, kept)` for each input row: `row` holds the columns `carry` (all by default), `q` the measures."""
    kept = [F.col(f"`{c}`") for c in (df.columns if carry is None else carry)]
    q = df.select(F.struct(*kept).alias("row"), F.col(f"`{host}`").alias("host"), measures(F.col(f"`{text}`")).alias("q"))
    measured = stored(q.withColumn("fails", F.struct(*(c.alias(r) for r, c in failures(F.col("q"), limits).items()))), "measured")
    verdicts = stored(host_verdicts(measured, limits), "verdicts")
    joined = _with_verdicts(measured, verdicts, limits.clear, most_keys)
    weighed = F.lit(0.0)
    for r, excess in excesses(F.col("q"), limits).items():
        weighed = weighed + F.when(F.col("fails")[r], excess / F.col(f"tolerance_{r}")).otherwise(0.0)
    failed = F.col("fails")["base"]
    return joined.select("row", "q", failed.alias("base_failed"), (~failed & ~F.col("blocked") & (weighed <= 1)).alias("kept"))
