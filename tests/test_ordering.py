import numpy as np
import pytest
from pyspark.sql import functions as F

from tabml.operators.components import connected_components
from tabml.operators.ordering import exact_quantiles, running_totals
from tabml.operators.sampling import bernoulli_holdout, holdout, systematic_sample
from tabml.sources.rows import with_row_id


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(1)
    values = np.round(rng.exponential(size=3000), 2)
    values[:1000] = 0.25  # one hot value
    return spark.createDataFrame([(i, float(v), i % 3) for i, v in enumerate(values)], "id bigint, v double, g int").repartition(7).cache(), values


def test_running_totals_over_ranges(spark, numbers):
    df, values = numbers
    split = running_totals(df, ["g"], ["v", "id"], {"t": F.col("v"), "r": F.lit(1)}, small_rows=10)
    whole = running_totals(df, ["g"], ["v", "id"], {"t": F.col("v"), "r": F.lit(1)})
    a, b = ({r["id"]: (r["r"], round(r["t"], 6)) for r in d.collect()} for d in (split, whole))
    assert a == b and len(a) == 3000


@pytest.mark.parametrize("small_rows", [10**6, 50])
def test_quantiles(spark, numbers, small_rows):
    df, values = numbers
    points = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    found = exact_quantiles(df, {"v": F.col("v"), "empty": F.lit(None).cast("double"), "id": F.col("id").cast("double")}, points, small_rows)
    got = {r["column"]: r["quantiles"] for r in found.collect()}
    assert set(got) == {"v", "id"}
    assert got["v"] == pytest.approx(list(np.quantile(values, points)))
    assert got["id"] == pytest.approx(list(np.quantile(np.arange(3000), points)))


@pytest.mark.parametrize("n,expected", [(1, 1), (3, 1), (4, 1), (30, 7), (25_003, 6250)])
def test_holdout_size(spark, n, expected):
    split = holdout(spark.range(n), key="id")
    assert split.where("is_test").count() == expected
    again = holdout(spark.range(n).repartition(5), key="id").where("is_test")
    assert again.exceptAll(split.where("is_test")).count() == 0


def test_bernoulli_share(spark):
    share = bernoulli_holdout(spark.range(20_000), key="id").where("is_test").count() / 20_000
    assert abs(share - 0.25) < 0.02


@pytest.mark.parametrize("n,limit", [(10, 3), (1000, 7), (2501, 2500), (30, 650), (1000, 999), (997, 613)])
def test_systematic_sample(spark, n, limit):
    got = sorted(r[0] * 2 for r in systematic_sample(spark.range(n).withColumn("k", F.col("id") * 2), limit, "k").select("id").collect())
    step = n / limit
    want = list(range(n)) if n <= limit else [int(np.floor(i * step)) for i in range(limit)]
    assert got == [2 * i for i in want]


def test_row_ids_follow_the_input(spark):
    df = with_row_id(spark.range(1000).repartition(6).sortWithinPartitions("id"))
    ids = sorted(r[0] for r in df.select("_row_id").collect())
    assert ids == list(range(1000))
    keyed = with_row_id(spark.createDataFrame([("b",), ("a",), ("c",)], "k string"), "k")
    assert {r["k"]: r["_row_id"] for r in keyed.collect()} == {"a": 0, "b": 1, "c": 2}


@pytest.mark.parametrize("small_edges", [0, 10**6])
def test_components(spark, small_edges):
    rng = np.random.default_rng(3)
    edges = [(i, i + 1) for i in range(100, 180)] + [tuple(map(int, e)) for e in rng.integers(0, 90, (60, 2))] + [(500, j) for j in range(501, 540)]
    parent = list(range(600))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    want = {v: root(v) for a, b in edges if a != b for v in (a, b)}
    got = connected_components(spark.createDataFrame(edges, "src bigint, dst bigint"), small_edges)
    assert {r["node"]: r["component"] for r in got.collect()} == want
