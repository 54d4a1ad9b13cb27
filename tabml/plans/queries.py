"""Registered queries: each operator on the supplied tables, always over whole tables.

Results are rounded to six digits here, not in the operators, so that engines can be compared.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.functions import fixed
from tabml.functions.values import as_number, format_number, is_missing
from tabml.operators import evaluate as ev
from tabml.operators import explain as ex
from tabml.operators import preprocess as pre
from tabml.operators import profile as pf
from tabml.operators.learners.base import dispersion_table
from tabml.operators.learners.dbscan import dbscan, DbscanModel, estimate_eps, minimum_points, train_dbscan
from tabml.operators.neighbors import nearest_neighbors
from tabml.operators.ordering import dense_positions, exact_quantiles
from tabml.operators.preprocess import TabularModel, TabularPreprocessor
from tabml.operators.projection import fit_pca
from tabml.operators.sampling import holdout, preview, systematic_sample, usable_rows
from tabml.operators.training import train
from tabml.plans.pipeline import Analysis, Trained, analyze, load_trained, train_and_evaluate
from tabml.sources.delimited import read_table
from tabml.sources.rows import ROW_ID, with_row_id
from tabml.sources.scratch import fresh_path
from tabml.streaming.scoring import read_stream, score_stream, write_scores, write_scores_by_batch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# A view of `orders` with missing tokens, malformed numbers, signs and blanks. {STR} is the text type.
DIRTY = {
    "row_id": "o_orderkey",
    "price_txt": """case when o_orderkey%23=0 then 'N/A' when o_orderkey%29=0 then '' when o_orderkey%31=0 then null
        when o_orderkey%37=0 then 'bad' when o_orderkey%41=0 then '1d'
        else concat('$', cast(cast(floor(round(o_totalprice*100)/100) as bigint) as {STR}), '.',
        lpad(cast(cast(round(o_totalprice*100) as bigint)%100 as {STR}),2,'0')) end""",
    "pct_txt": "concat(cast(o_orderkey%100 as {STR}),'%')",
    "status_txt": "case when o_orderkey%19=0 then ' NA ' when o_orderkey%17=0 then 'none' else concat(' ',o_orderstatus,' ') end",
    "class_txt": "cast(o_orderkey%5 as {STR})",
    "mixed_txt": "case when o_orderkey%5=0 then 'x' else cast(o_orderkey as {STR}) end",
    "empty_txt": "'?'",
}
DIRTY_COLUMNS = [c for c in DIRTY if c != "row_id"]
KMEANS_START, KMEANS_ROUNDS = [(-1.0, -1.0), (0.0, 0.0), (1.0, 1.0)], 3
DBSCAN_EPS, DBSCAN_MIN_PTS = 0.1, 5
EMBEDDING_EPS, EMBEDDING_MIN_PTS = 1.15, 4
# Of at least 128 cells. The embeddings have no structure, so neighbours lie in many cells.
KNN_PROBES = 84


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*[f"{e.format(STR='string')} as {c}" for c, e in DIRTY.items()])


def rounded(value: Column | str) -> Column:
    return F.floor((F.col(value) if isinstance(value, str) else value) * 1e6 + 0.5) / 1e6


def rounded_columns(df: DataFrame) -> DataFrame:
    return df.withColumns({n: rounded(n) for n, t in df.dtypes if t == "double"})


def stacked(*parts: tuple[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [df.withColumn("source", F.lit(name)) for name, df in parts])


# --- values, rows, sources ---------------------------------------------------------------------


@query
def expr_missing(spark, sf_dir):
    df = dirty(spark, sf_dir)
    return df.select("row_id", *[is_missing(df, c).cast("int").alias(c) for c in DIRTY_COLUMNS])


@query
def expr_to_number(spark, sf_dir):
    df = dirty(spark, sf_dir)
    return df.select("row_id", *[as_number(df, c).alias(c) for c in DIRTY_COLUMNS])


@query
def filter_usable_rows(spark, sf_dir):
    df = dirty(spark, sf_dir)
    cases = (("price_txt", "regression"), ("status_txt", "classification"), ("mixed_txt", "regression"), (None, "unsupervised"))
    return stacked(*[(f"{t}/{p}", usable_rows(df, t, p).select("row_id")) for t, p in cases])


@query
def src_csv_shape(spark, sf_dir):
    path = fresh_path(spark, "orders-csv")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    orders.write.csv(path, header=True, sep=";")
    back = read_table(spark, path, multiline=False)
    return back.select(
        F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("bigint"), "o_orderstatus", as_number(back, "o_totalprice").alias("o_totalprice"), "o_orderpriority"
    )


@query
def row_id_by_key(spark, sf_dir):
    return with_row_id(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_name").withColumnRenamed(ROW_ID, "row_id")


@query
def preview_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return preview(orders, "o_orderkey")


@query
def sample_systematic(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    caps = (fixed.ROW_CAP, fixed.DBSCAN_ROW_CAP)
    return stacked(*[(str(cap), systematic_sample(orders, cap, "o_orderkey")) for cap in caps])


@query
def split_holdout(spark, sf_dir):
    return holdout(table(spark, sf_dir, "orders").select("o_orderkey"), key="o_orderkey").withColumn("is_test", F.col("is_test").cast("int"))


# --- profile ------------------------------------------------------------------------------------


@query
def profile_columns(spark, sf_dir):
    return rounded_columns(pf.profile_columns(dirty(spark, sf_dir), DIRTY_COLUMNS))


@query
def profile_dataset(spark, sf_dir):
    return pf.profile_dataset(dirty(spark, sf_dir), DIRTY_COLUMNS)


@query
def missing_top8(spark, sf_dir):
    return pf.missing_ranking(dirty(spark, sf_dir), DIRTY_COLUMNS)


PROBLEM_TARGETS = (
    ("part", "p_size"), ("lineitem", "l_linenumber"), ("lineitem", "l_tax"), ("lineitem", "l_quantity"),
    ("orders", "o_orderstatus"), ("dirty", "class_txt"), ("dirty", "price_txt"), ("dirty", "mixed_txt"),
)


@query
def problem_type(spark, sf_dir):
    parts = []
    for name, target in PROBLEM_TARGETS:
        df = dirty(spark, sf_dir) if name == "dirty" else table(spark, sf_dir, name)
        parts.append((f"{name}.{target}", pf.diagnose(df.select(target), target)))
    parts.append(("orders", pf.diagnose(table(spark, sf_dir, "orders"), "o_orderstatus", "unsupervised")))
    return stacked(*parts)


@query
def target_class_counts(spark, sf_dir):
    return pf.target_summary(dirty(spark, sf_dir), "status_txt", "classification")


@query
def target_values(spark, sf_dir):
    return pf.target_summary(dirty(spark, sf_dir), "price_txt", "regression")


@query
def count_values_first_seen(spark, sf_dir):
    return pf.first_seen_counts(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", "o_orderkey")


@query
def histogram_value(spark, sf_dir):
    return rounded_columns(pf.histogram(table(spark, sf_dir, "events").select("value"), "value"))


@query
def histogram_first_numeric(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    first = next(iter(analyze(docs, key="doc_id").preprocessor.numeric_stats))
    return rounded_columns(pf.histogram(docs, first).withColumn("column", F.lit(first)))


@query
def quartiles(spark, sf_dir):
    return rounded_columns(
        stacked(
            ("events", pf.quartiles(table(spark, sf_dir, "events"), ["value", "user_id"])),
            ("documents", pf.quartiles(table(spark, sf_dir, "documents"), ["n_chars"])),
            ("lineitem", pf.quartiles(table(spark, sf_dir, "lineitem"), ["l_extendedprice", "l_discount"])),
        )
    )


@query
def mean_std(spark, sf_dir):
    return rounded_columns(
        stacked(
            ("events", pf.moments(table(spark, sf_dir, "events"), ["value", "user_id"])),
            ("dirty", pf.moments(dirty(spark, sf_dir), ["price_txt", "pct_txt", "empty_txt"])),
        )
    )


@query
def minmax_scale(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return rounded_columns(pf.min_max_scaled(docs, "n_chars", "scaled")).drop("n_chars")


# --- preprocessing ------------------------------------------------------------------------------


def events_with_k(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", "event_type", "value", "user_id", F.get_json_object("props", "$.k").cast("double").alias("k")
    )


def numeric_fits(spark, sf_dir) -> list[tuple[str, TabularModel]]:
    return [
        ("events", TabularPreprocessor(features=["value", "user_id"]).fit(table(spark, sf_dir, "events"))),
        ("documents", TabularPreprocessor(features=["n_chars"]).fit(table(spark, sf_dir, "documents"))),
        ("dirty", TabularPreprocessor(features=["price_txt", "pct_txt"]).fit(dirty(spark, sf_dir))),
    ]


@query
def fit_numeric(spark, sf_dir):
    return rounded_columns(stacked(*[(name, m.stats_table(spark)) for name, m in numeric_fits(spark, sf_dir)]))


@query
def outlier_counts(spark, sf_dir):
    rows = [(name, m.outlier_count, m.missing_count) for name, m in numeric_fits(spark, sf_dir)]
    return spark.createDataFrame(rows, "source string, outliers bigint, missing bigint")


@query
def transform_numeric(spark, sf_dir):
    df = dirty(spark, sf_dir)
    model = TabularPreprocessor(features=["price_txt", "pct_txt"]).fit(df)
    events = table(spark, sf_dir, "events")
    other = TabularPreprocessor(features=["value", "user_id"]).fit(events)

    def pair(scaled, key):
        return scaled.select(F.col(key).alias("id"), rounded(F.col("features")[0]).alias("z0"), rounded(F.col("features")[1]).alias("z1"))

    return stacked(("dirty", pair(model.transform(df), "row_id")), ("events", pair(other.transform(events), "event_id")))


def categorical_fits(spark, sf_dir):
    return [
        ("part", ["p_brand", "p_type", "p_name"], TabularPreprocessor(features=["p_brand", "p_type", "p_name"]).fit(table(spark, sf_dir, "part"))),
        ("customer", ["c_mktsegment", "c_name"], TabularPreprocessor(features=["c_mktsegment", "c_name"]).fit(table(spark, sf_dir, "customer"))),
        ("dirty", ["status_txt", "empty_txt"], TabularPreprocessor(features=["status_txt", "empty_txt"]).fit(dirty(spark, sf_dir))),
    ]


@query
def fit_categorical(spark, sf_dir):
    parts = [(name, m.categories_table(spark).withColumn("categories", F.array_join("categories", "|"))) for name, _, m in categorical_fits(spark, sf_dir)]
    return stacked(*parts)


def _bits(model: TabularModel, df: DataFrame, key: str) -> DataFrame:
    bits = F.array_join(F.transform("features", lambda x: x.cast("int").cast("string")), "")
    return model.transform(df).select(F.col(key).alias("id"), bits.alias("onehot"))


@query
def transform_onehot(spark, sf_dir):
    part, df = table(spark, sf_dir, "part"), dirty(spark, sf_dir)
    return stacked(
        ("part", _bits(TabularPreprocessor(features=["p_brand"]).fit(part), part, "p_partkey")),
        ("dirty", _bits(TabularPreprocessor(features=["status_txt"]).fit(df), df, "row_id")),
    )


@query
def encode_target(spark, sf_dir):
    df = dirty(spark, sf_dir).select("row_id", "status_txt")
    model = TabularPreprocessor("status_txt", "classification", []).fit(df)
    return model.transform(usable_rows(df, "status_txt", "classification")).select("row_id", "label")


CUSTOMER_FEATURES = ["c_acctbal", "c_nationkey", "c_mktsegment"]


@query
def feature_names(spark, sf_dir):
    return TabularPreprocessor(features=CUSTOMER_FEATURES).fit(table(spark, sf_dir, "customer")).feature_table(spark)


@query
def feature_kind_counts(spark, sf_dir):
    return TabularPreprocessor(features=CUSTOMER_FEATURES).fit(table(spark, sf_dir, "customer")).kind_counts(spark)


@query
def preprocessing_summary(spark, sf_dir):
    events, df = events_with_k(spark, sf_dir), dirty(spark, sf_dir)
    return stacked(
        ("events", TabularPreprocessor("event_type", "classification", ["value", "user_id", "k"]).fit(events).summary(spark)),
        ("dirty", TabularPreprocessor("price_txt", "regression", ["pct_txt", "status_txt", "empty_txt"]).fit(df).summary(spark)),
        ("part", TabularPreprocessor(features=["p_brand"]).fit(table(spark, sf_dir, "part")).summary(spark)),
    )


@query
def health_summary(spark, sf_dir):
    events = events_with_k(spark, sf_dir).drop("event_id")
    found = analyze(events, "event_type")
    return pre.health_summary(events, found.preprocessor, found.rationale)


@query
def feature_dispersion(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    model = TabularPreprocessor(features=CUSTOMER_FEATURES).fit(customer)
    return rounded_columns(dispersion_table(model.transform(customer), model.feature_names))


# --- supervised learners ------------------------------------------------------------------------


def events_analysis(spark, sf_dir) -> Analysis:
    return analyze(events_with_k(spark, sf_dir), "event_type", key="event_id")


def bayes(spark, sf_dir) -> Trained:
    return train_and_evaluate(events_analysis(spark, sf_dir), "naiveBayes")


def part_analysis(spark, sf_dir) -> Analysis:
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_partkey").alias("number"), "p_size", "p_retailprice")
    return analyze(part, "p_retailprice", key="p_partkey")


def linear(spark, sf_dir) -> Trained:
    return train_and_evaluate(part_analysis(spark, sf_dir), "linearRegression")


@query
def nb_fit(spark, sf_dir):
    return rounded_columns(bayes(spark, sf_dir).model.parameters_table(spark))


@query
def nb_predict(spark, sf_dir):
    t = bayes(spark, sf_dir)
    return t.model.transform(t.test_rows).select("event_id", "label", "prediction", rounded(F.array_max("probability")).alias("top_probability"))


@query
def linreg_fit(spark, sf_dir):
    return rounded_columns(linear(spark, sf_dir).model.weights_table(spark))


@query
def linreg_predict(spark, sf_dir):
    t = linear(spark, sf_dir)
    return rounded_columns(ev.actual_vs_predicted(t.model.transform(t.test_rows), "p_partkey"))


def embedding_rows(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("features"), F.col("label").cast("double").alias("label"))


@query
def knn_neighbors(spark, sf_dir):
    rows = embedding_rows(spark, sf_dir)
    return rounded_columns(nearest_neighbors(rows, rows, 5, "vec_id", "vec_id", exclude_self=True))


@query
def knn_classify(spark, sf_dir):
    split = holdout(embedding_rows(spark, sf_dir), key="vec_id")
    model = train("classification", "knnClassifier", split.where(~F.col("is_test")), key="vec_id", classes=10)
    return model.transform(split.where("is_test")).select("vec_id", "label", "prediction", rounded(F.array_max("probability")).alias("top_probability"))


@query
def knn_regress(spark, sf_dir):
    split = settled_split(part_analysis(spark, sf_dir))
    model = train("regression", "knnRegressor", split.where(~F.col("is_test")), key="p_partkey")
    return rounded_columns(ev.actual_vs_predicted(model.transform(split.where("is_test")), "p_partkey"))


def softmax(spark, sf_dir) -> Trained:
    return train_and_evaluate(events_analysis(spark, sf_dir), "logistic")


@query
def softmax_fit(spark, sf_dir):
    return rounded_columns(softmax(spark, sf_dir).model.weights_table(spark))


@query
def softmax_predict(spark, sf_dir):
    t = softmax(spark, sf_dir)
    return t.model.transform(t.test_rows).select("event_id", "label", "prediction", rounded(F.array_max("probability")).alias("top_probability"))


def settled_split(analysis: Analysis) -> DataFrame:
    """Prepared rows with `is_test` and features rounded to nine digits.

    The last bit of a standardised value differs between engines. That decides on which side of a split
    between two other values a row lies, or which of two neighbours at equal distance is nearer.
    """
    rows = analysis.prepared().withColumn("features", F.transform("features", lambda x: F.floor(x * 1e9 + 0.5) / 1e9))
    return holdout(rows, key=analysis.key)


def grown(analysis: Analysis, algorithm: str, **options) -> DataFrame:
    """Holdout rows scored by trees with exact splits."""
    split = settled_split(analysis)
    if analysis.problem_type == "classification":
        options["classes"] = len(analysis.preprocessor.classes)
    model = train(analysis.problem_type, algorithm, split.where(~F.col("is_test")), method="node", **options)
    return model.transform(split.where("is_test"))


def _with_share(scored: DataFrame) -> DataFrame:
    return scored.select("event_id", "label", "prediction", rounded(F.array_max("probability")).alias("top_probability"))


@query
def tree_classify(spark, sf_dir):
    return _with_share(grown(events_analysis(spark, sf_dir), "treeClassifier"))


@query
def tree_regress(spark, sf_dir):
    return rounded_columns(grown(part_analysis(spark, sf_dir), "treeRegressor").select("p_partkey", "label", "prediction"))


@query
def forest_classify(spark, sf_dir):
    return _with_share(grown(events_analysis(spark, sf_dir), "forestClassifier", key="event_id"))


@query
def forest_regress(spark, sf_dir):
    return rounded_columns(grown(part_analysis(spark, sf_dir), "forestRegressor", key="p_partkey").select("p_partkey", "label", "prediction"))


# --- clustering and projection ------------------------------------------------------------------


def customer_points(spark, sf_dir) -> tuple[TabularModel, DataFrame]:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    model = TabularPreprocessor(features=["c_acctbal", "c_nationkey"]).fit(customer)
    return model, model.transform(customer)


def lloyd(spark, sf_dir):
    _, points = customer_points(spark, sf_dir)
    return train("unsupervised", "kmeans", points, init_centers=KMEANS_START, rounds=KMEANS_ROUNDS), points


@query
def kmeans_lloyd(spark, sf_dir):
    return rounded_columns(lloyd(spark, sf_dir)[0].centers_table(spark))


@query
def kmeans_assign(spark, sf_dir):
    model, points = lloyd(spark, sf_dir)
    return model.transform(points).select("c_custkey", F.col("prediction").cast("int").alias("prediction"))


@query
def kmeans_inertia(spark, sf_dir):
    model, points = lloyd(spark, sf_dir)
    return rounded_columns(model.inertia(points))


@query
def kmeans_drawn_rows(spark, sf_dir):
    """From three drawn rows until nothing changes."""
    _, points = customer_points(spark, sf_dir)
    model = train("unsupervised", "kmeans", points, key="c_custkey")
    return model.transform(points).select("c_custkey", F.col("prediction").cast("int").alias("prediction"))


@query
def dbscan_eps(spark, sf_dir):
    _, points = customer_points(spark, sf_dir)
    eps = rounded_columns(estimate_eps(points, "c_custkey"))
    return eps.withColumn("min_pts", F.lit(minimum_points(points.count())))


def customer_clusters(spark, sf_dir) -> tuple[TabularModel, DbscanModel, DataFrame]:
    prep, points = customer_points(spark, sf_dir)
    return prep, train_dbscan(points, "c_custkey", DBSCAN_EPS, DBSCAN_MIN_PTS), points


@query
def dbscan_core(spark, sf_dir):
    return customer_clusters(spark, sf_dir)[1].assignments.select("c_custkey", F.col("is_core").cast("int").alias("is_core"))


@query
def dbscan_labels(spark, sf_dir):
    return customer_clusters(spark, sf_dir)[1].assignments.select("c_custkey", "prediction")


@query
def dbscan_auto(spark, sf_dir):
    """With eps and the smallest neighbourhood derived from the data."""
    _, points = customer_points(spark, sf_dir)
    return train_dbscan(points, "c_custkey").assignments.select("c_custkey", F.col("is_core").cast("int").alias("is_core"), "prediction")


@query
def dbscan_predict(spark, sf_dir):
    prep, model, _ = customer_clusters(spark, sf_dir)
    new = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_acctbal").alias("c_acctbal"), F.col("s_nationkey").alias("c_nationkey"))
    return model.transform(prep.transform(new)).select(F.col("c_custkey").alias("s_suppkey"), "prediction")


@query
def cluster_summary(spark, sf_dir):
    return ev.cluster_summary(customer_clusters(spark, sf_dir)[1].assignments)


@query
def pca_2d(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    prepared = TabularPreprocessor(features=["p_size", "p_retailprice"]).fit(part).transform(part)
    return rounded_columns(fit_pca(prepared).transform(prepared).select("p_partkey", "pc1", "pc2"))


# --- evaluation, explanation, scoring -----------------------------------------------------------


@query
def eval_regression(spark, sf_dir):
    return rounded_columns(linear(spark, sf_dir).metrics)


@query
def eval_confusion(spark, sf_dir):
    t = bayes(spark, sf_dir)
    return ev.confusion_matrix(t.model.transform(t.test_rows), len(t.analysis.preprocessor.classes))


@query
def confusion_view(spark, sf_dir):
    t = bayes(spark, sf_dir)
    return ev.confusion_view(t.model.transform(t.test_rows), t.analysis.preprocessor.classes)


@query
def eval_class_metrics(spark, sf_dir):
    t = bayes(spark, sf_dir)
    return rounded_columns(ev.class_metrics(t.model.transform(t.test_rows), len(t.analysis.preprocessor.classes)))


@query
def eval_classification(spark, sf_dir):
    return rounded_columns(bayes(spark, sf_dir).metrics)


@query
def importance_top8(spark, sf_dir):
    t = bayes(spark, sf_dir)
    return rounded_columns(ev.importance_ranking(spark, t.model.importances, t.analysis.preprocessor.feature_names))


def signal_text(columns: DataFrame, *names: str) -> DataFrame:
    return columns.select(*names, F.explode("signals").alias("s")).select(
        *names, F.col("s.name").alias("feature"), rounded(F.col("s.contribution")).alias("contribution"), F.col("s.direction").alias("direction")
    )


@query
def explain_signals(spark, sf_dir):
    t = linear(spark, sf_dir)
    explained = ex.explain("regression", t.model, t.test_rows, t.analysis.preprocessor.feature_names)
    return signal_text(explained, "p_partkey")


@query
def explain_class(spark, sf_dir):
    t = bayes(spark, sf_dir)
    a = t.analysis.preprocessor
    explained = ex.explain("classification", t.model, t.test_rows, a.feature_names, a.classes)
    return explained.select("event_id", "headline", "why", "why_not", F.array_join(F.transform("signals", lambda s: s["name"]), "|").alias("signals"))


@query
def explain_regression(spark, sf_dir):
    t = linear(spark, sf_dir)
    explained = ex.explain("regression", t.model, t.test_rows, t.analysis.preprocessor.feature_names)
    return explained.select("p_partkey", "headline", "why", "why_not")


@query
def explain_cluster(spark, sf_dir):
    _, model, _ = customer_clusters(spark, sf_dir)
    return ex.explain_clusters(model.assignments).select("c_custkey", "headline", "why", "why_not")


@query
def score_batch(spark, sf_dir):
    t = bayes(spark, sf_dir)
    return t.score(events_with_k(spark, sf_dir)).select("event_id", "predicted_label")


@query
def score_stream_files(spark, sf_dir):
    """The same scores computed by a stream over the table's file."""
    t = bayes(spark, sf_dir)
    source = table(spark, sf_dir, "events")
    stream = read_stream(spark, sf_dir, source.schema, pathGlobFilter="events.parquet").select(
        "event_id", "value", "user_id", F.get_json_object("props", "$.k").cast("double").alias("k")
    )
    out = fresh_path(spark, "scores")
    scored = score_stream(t, stream).select("event_id", "predicted_label")
    write_scores(scored, out, fresh_path(spark, "scores-state")).awaitTermination()
    return spark.read.schema(scored.schema).parquet(out)


@query
def score_stream_clusters(spark, sf_dir):
    """Clusters of new rows that arrive as a stream; DBSCAN needs a join, so each batch is scored as a table."""
    prep, model, _ = customer_clusters(spark, sf_dir)
    schema = table(spark, sf_dir, "supplier").schema
    stream = read_stream(spark, sf_dir, schema, pathGlobFilter="supplier.parquet").select(
        F.col("s_suppkey").alias("c_custkey"), F.col("s_acctbal").alias("c_acctbal"), F.col("s_nationkey").alias("c_nationkey")
    )
    out = fresh_path(spark, "clusters")

    def score(batch):
        return model.transform(prep.transform(batch)).select(F.col("c_custkey").alias("s_suppkey"), "prediction")

    write_scores_by_batch(score, stream, out, fresh_path(spark, "clusters-state")).awaitTermination()
    return spark.read.parquet(out).drop("batch")


@query
def score_stored(spark, sf_dir):
    """Scores of a model that was written and read back."""
    t = bayes(spark, sf_dir)
    path = fresh_path(spark, "model")
    t.save(path)
    return load_trained(spark, path).score(events_with_k(spark, sf_dir)).select("event_id", "predicted_label")


# --- the ways of large tables, forced on small ones -------------------------------------------------


@query
def quartiles_ranges(spark, sf_dir):
    parts = (("events", ["value", "user_id"]), ("documents", ["n_chars"]), ("lineitem", ["l_extendedprice", "l_discount"]))
    found = []
    for name, columns in parts:
        df = table(spark, sf_dir, name)
        ranked = exact_quantiles(df, {c: as_number(df, c) for c in columns}, [0.25, 0.5, 0.75], small_rows=0)
        found.append((name, ranked.select("column", F.col("quantiles")[0].alias("q1"), F.col("quantiles")[1].alias("median"), F.col("quantiles")[2].alias("q3"))))
    return rounded_columns(stacked(*found))


@query
def row_id_ranges(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return dense_positions(customer, ["c_name"], "row_id", small_rows=0)


@query
def knn_cells(spark, sf_dir):
    rows = embedding_rows(spark, sf_dir)
    return rounded_columns(nearest_neighbors(rows, rows, 5, "vec_id", "vec_id", exclude_self=True, small_bytes=0))


@query
def knn_approx(spark, sf_dir):
    """Approximate neighbours: the nearest cells only."""
    rows = embedding_rows(spark, sf_dir)
    return rounded_columns(nearest_neighbors(rows, rows, 5, "vec_id", "vec_id", exclude_self=True, probes=KNN_PROBES))


@query
def dbscan_embeddings(spark, sf_dir):
    """Clusters in 64 dimensions."""
    found = dbscan(embedding_rows(spark, sf_dir), EMBEDDING_EPS, EMBEDDING_MIN_PTS, "vec_id")
    return found.select("vec_id", F.col("is_core").cast("int").alias("is_core"), "prediction")


@query
def knn_classify_cells(spark, sf_dir):
    split = holdout(embedding_rows(spark, sf_dir), key="vec_id")
    model = train("classification", "knnClassifier", split.where(~F.col("is_test")), key="vec_id", classes=10, small_bytes=0)
    return model.transform(split.where("is_test")).select("vec_id", "label", "prediction", rounded(F.array_max("probability")).alias("top_probability"))


@query
def dbscan_star(spark, sf_dir):
    _, points = customer_points(spark, sf_dir)
    model = train_dbscan(points, "c_custkey", DBSCAN_EPS, DBSCAN_MIN_PTS, small_edges=0)
    return model.assignments.select("c_custkey", "prediction")


@query
def dbscan_predict_cells(spark, sf_dir):
    prep, points = customer_points(spark, sf_dir)
    model = train_dbscan(points, "c_custkey", DBSCAN_EPS, DBSCAN_MIN_PTS, small_bytes=0)
    new = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_acctbal").alias("c_acctbal"), F.col("s_nationkey").alias("c_nationkey"))
    return model.transform(prep.transform(new)).select(F.col("c_custkey").alias("s_suppkey"), "prediction")


@query
def src_csv_messy(spark, sf_dir):
    """Whole texts with quotes, separators and line breaks, headers that differ by blanks only."""
    path = fresh_path(spark, "documents-csv")
    docs = table(spark, sf_dir, "documents")
    quoted = F.concat(F.lit('said "'), F.col("lang"), F.lit('"; '), F.col("source"))
    docs.select("doc_id", "text", quoted.alias("note"), F.col("lang").alias("note ")).write.csv(path, header=True, sep=";", quote='"', escape='"')
    back = read_table(spark, path)
    return back.select(F.col("doc_id").cast("bigint").alias("doc_id"), *[c for c in back.columns if c != "doc_id"])


KMEANS_MANY = [(a, b) for a in (-1.5, -0.5, 0.5, 1.5) for b in (-1.0, 0.0, 1.0)]


@query
def kmeans_many(spark, sf_dir):
    """Twelve clusters."""
    _, points = customer_points(spark, sf_dir)
    model = train("unsupervised", "kmeans", points, init_centers=KMEANS_MANY, rounds=KMEANS_ROUNDS)
    return model.transform(points).select("c_custkey", F.col("prediction").cast("int").alias("prediction"))


@query
def profile_wide_ids(spark, sf_dir):
    """Whole numbers that doubles can't tell apart."""
    wide = table(spark, sf_dir, "orders").select((F.lit(9007199254740992).cast("long") + F.col("o_orderkey")).alias("wide_id"))
    return pf.profile_columns(wide, ["wide_id"]).select("column", "unique", "missing")


@query
def format_ties(spark, sf_dir):
    """Numbers halfway between two texts."""
    keys = table(spark, sf_dir, "orders").select("o_orderkey")
    return keys.select("o_orderkey", format_number(F.col("o_orderkey") / 8).alias("eighth"), format_number(F.col("o_orderkey") % 1600 / -16).alias("sixteenth"))


def _explained(t: Trained, rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    a = t.analysis.preprocessor
    return ex.explain(t.analysis.problem_type, t.model, rows, a.feature_names, a.classes or ()).select(key, *columns)


@query
def explain_softmax(spark, sf_dir):
    t = softmax(spark, sf_dir)
    explained = _explained(t, t.test_rows, "event_id", ["headline", "why", "why_not", "signals"])
    return explained.withColumn("signals", F.array_join(F.transform("signals", lambda s: s["name"]), "|"))


@query
def explain_kmeans(spark, sf_dir):
    model, points = lloyd(spark, sf_dir)
    return ex.explain_clusters(model.transform(points)).select("c_custkey", "headline", "why", "why_not")


# --- learners without a SQL counterpart ---------------------------------------------------------


def _scored(t: Trained, key: str) -> DataFrame:
    return rounded_columns(t.model.transform(t.test_rows).select(key, "label", "prediction"))


@query
def softmax_converged(spark, sf_dir):
    return _scored(train_and_evaluate(events_analysis(spark, sf_dir), "logistic", solver="converged"), "event_id")


@query
def forest_classify_bins(spark, sf_dir):
    return _scored(train_and_evaluate(events_analysis(spark, sf_dir), "forestClassifier", method="bins"), "event_id")


@query
def forest_regress_bins(spark, sf_dir):
    return _scored(train_and_evaluate(part_analysis(spark, sf_dir), "forestRegressor", method="bins"), "p_partkey")


@query
def tree_classify_bins(spark, sf_dir):
    return _scored(train_and_evaluate(events_analysis(spark, sf_dir), "treeClassifier", method="bins"), "event_id")


@query
def tree_regress_bins(spark, sf_dir):
    return _scored(train_and_evaluate(part_analysis(spark, sf_dir), "treeRegressor", method="bins"), "p_partkey")


@query
def kmeans_spark(spark, sf_dir):
    _, points = customer_points(spark, sf_dir)
    return train("unsupervised", "kmeans", points, method="spark").transform(points).select("c_custkey", "prediction")
