import datetime

import numpy as np
import pytest

from tabml.operators import profile as pf
from tabml.operators.preprocess import TabularPreprocessor
from tabml.operators.sampling import usable_rows


def features(model, df, key="id"):
    return {r[key]: r["features"] for r in model.transform(df).collect()}


def test_profile_kinds(spark):
    rows = [(str(i) if i < 17 else "x", None, "?", float("nan") if i == 0 else float(i), i % 2 == 0, datetime.date(2024, 1, 1 + i % 3)) for i in range(20)]
    df = spark.createDataFrame(rows, "edge string, none string, q string, typed double, flag boolean, day date")
    got = {r["column"]: (r["kind"], r["missing"], r["unique"]) for r in pf.profile_columns(df).collect()}
    assert got == {
        "edge": ("numeric", 0, 18), "none": ("categorical", 20, 0), "q": ("categorical", 20, 0), "typed": ("numeric", 1, 19),
        "flag": ("categorical", 0, 2), "day": ("categorical", 0, 3),
    }
    approx = {r["column"]: (r["kind"], r["missing"]) for r in pf.profile_columns(df, distinct="approx").collect()}
    assert approx == {c: v[:2] for c, v in got.items()}


def test_numeric_pipeline(spark):
    values = ["1", "2", "3", "4", "100", "bad", "", "$2"]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v string")
    # 6 of 7 present values parse, which is enough for a numeric column.
    model = TabularPreprocessor(features=["v"]).fit(df)
    s = model.numeric_stats["v"]
    known = np.array([1, 2, 3, 4, 100, 2.0])
    q1, median, q3 = np.quantile(known, [0.25, 0.5, 0.75])
    filled = np.array([1, 2, 3, 4, 100, median, median, 2.0])
    capped = np.clip(filled, q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
    assert (s.q1, s.median, s.q3, s.missing) == pytest.approx((q1, median, q3, 1))
    assert (s.mean, s.std, model.outlier_count) == pytest.approx((capped.mean(), capped.std(), 1))
    got = features(model, df)
    assert [got[i][0] for i in range(8)] == pytest.approx(list((capped - capped.mean()) / capped.std()))


def test_no_spread_keeps_values_but_counts_outliers(spark):
    df = spark.createDataFrame([(i, 5.0 if i < 9 else 50.0, 7.0) for i in range(10)], "id int, v double, same double")
    model = TabularPreprocessor(features=["v", "same"]).fit(df)
    assert model.numeric_stats["v"].lower == model.numeric_stats["v"].upper == 5.0
    assert model.outlier_count == 1
    assert model.numeric_stats["v"].mean == pytest.approx(9.5)
    assert model.numeric_stats["same"].std == 1.0


def test_categories(spark):
    names = [f"c{i:02d}" for i in range(15)]
    rows = [(k, n) for k, n in enumerate(n for i, n in enumerate(names) for _ in range(15 - i))] + [(900 + i, None) for i in range(20)]
    df = spark.createDataFrame(rows, "id int, c string")
    model = TabularPreprocessor(features=["c"]).fit(df)
    s = model.categorical_stats["c"]
    assert s.mode == "__missing__" and s.missing == 20
    assert s.categories == ["__missing__", *names[:11], "__other__"]
    assert model.feature_names[:2] == ["c = __missing__", "c = c00"]
    new = spark.createDataFrame([(0, "c00"), (1, " c14 "), (2, "unseen"), (3, None), (4, "?")], "id int, c string")
    hot = {i: v.index(1.0) for i, v in features(model, new).items()}
    assert hot == {0: 1, 1: 12, 2: 12, 3: 0, 4: 0}
    assert all(sum(v) == 1 for v in features(model, new).values())


def test_odd_column_names(spark):
    df = spark.createDataFrame([(i, float(i), "a" if i % 2 else "b") for i in range(6)], ["id", "a.b", "c`d e"])
    model = TabularPreprocessor(features=["a.b", "c`d e"]).fit(df)
    assert model.feature_names == ["a.b", "c`d e = a", "c`d e = b", "c`d e = __other__"]
    assert len(features(model, df)[0]) == 4
    assert pf.profile_columns(df, ["a.b", "c`d e"]).count() == 2


def test_target_encoding_and_filter(spark):
    df = spark.createDataFrame([(0, "10"), (1, "2"), (2, None), (3, " 2 "), (4, "x")], "id int, y string")
    rows = usable_rows(df, "y", "classification")
    model = TabularPreprocessor("y", "classification", []).fit(df)
    assert model.classes == ["10", "2", "x"]
    assert {r["id"]: r["label"] for r in model.transform(rows).collect()} == {0: 0.0, 1: 1.0, 3: 1.0, 4: 2.0}
    assert sorted(r["id"] for r in usable_rows(df, "y", "regression").collect()) == [0, 1, 3]
    assert usable_rows(df, None, "unsupervised").count() == 5


@pytest.mark.parametrize(
    "values,expected",
    [
        ([str(i % 3) for i in range(60)], "classification"),
        ([str(i % 20) for i in range(60)], "regression"),
        ([str(i % 2) for i in range(4)], "classification"),
        ([str(i + 0.5) for i in range(60)], "regression"),
        (["a", "b"] * 20, "classification"),
    ],
)
def test_diagnosis(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "y string")
    assert pf.diagnose(df, "y").first()["problem_type"] == expected
    assert pf.diagnose(df, "y", "unsupervised").first()["problem_type"] == "unsupervised"
    assert pf.diagnose(df).first()["problem_type"] == "unsupervised"
    with pytest.raises(ValueError):
        pf.diagnose(df, None, "supervised")


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 0, 1, 10]], "v double")
    assert [(r["bin"], r["n"]) for r in pf.histogram(df, "v").orderBy("bin").collect()] == [(0, 3), (1, 0), (2, 0), (3, 1)]
    same = spark.createDataFrame([(2.0,), (2.0,), (None,)], "v double")
    assert [tuple(r) for r in pf.histogram(same, "v").collect()] == [(0, 2.0, 2.0, 2)]
    assert pf.histogram(same.where("v is null"), "v").count() == 0
    scaled = pf.min_max_scaled(same, "v", "s").collect()
    assert [r["s"] for r in scaled] == [0.5, 0.5, None]


def test_many_classes_use_a_join(spark):
    df = spark.range(600).selectExpr("id", "concat('c', lpad(cast(id % 300 as string), 3, '0')) as y")
    model = TabularPreprocessor("y", "classification", []).fit(df)
    got = {r["id"]: r["label"] for r in model.transform(df).collect()}
    assert len(got) == 600 and all(v == i % 300 for i, v in got.items())
