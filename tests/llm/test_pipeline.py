"""The pipeline, stage by stage, against plain definitions; the registered queries against SQL."""

from collections import Counter

import corpus_pipeline
import duckdb
import pytest

from tabml.llm import queries
from tests.compare import compare, connect
from tests.llm.test_pairs import _components, _contamination

DATA = "/root/testdata/sf0.001"


def _rows(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source").collect()]


def test_stages_do_what_they_say(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "near-dedup", "decontamination", "mixing", "sharding"]

    good = stages["quality rules"](spark, docs, DATA)
    assert good.columns == docs.columns
    verdict = duckdb.connect()
    verdict.execute(f"create view documents as select * from '{DATA}/documents.parquet'")
    kept = {r[0] for r in verdict.execute(queries.ORACLE["op10_quality"]).fetchall() if r[7]}
    assert {r[0] for r in _rows(good)} == kept

    once = stages["near-dedup"](spark, good, DATA)
    assert once.columns == docs.columns
    want = {c for _, _, c in _components(_rows(good), 80)}
    assert {r[0] for r in _rows(once)} == want and once.count() == len(want)

    clean = stages["decontamination"](spark, once, DATA)
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    want = {r[0] for r in _contamination(_rows(once), items) if not (r[2] > 0 and 20 * r[2] >= r[1])}
    assert clean.columns == docs.columns and {r[0] for r in _rows(clean)} == want

    mixed = stages["mixing"](spark, clean, DATA)
    assert mixed.columns == docs.columns
    verdict.register("clean", clean.toPandas())
    plan = verdict.execute(queries.ORACLE["op3_mixing"].replace("from documents", "from clean")).fetchall()
    times = {r[0]: r[4] // r[1] for r in plan if r[4]}
    assert Counter(r[0] for r in _rows(mixed)) == Counter(times)

    placed = stages["sharding"](spark, mixed, DATA)
    assert plain_rows(placed.select(*docs.columns)) == plain_rows(mixed)
    found = placed.select("shard", "slot", "text").collect()
    for s in {r["shard"] for r in found}:
        slots = [r["slot"] for r in found if r["shard"] == s]
        assert sorted(slots) == list(range(len(slots)))
    assert len({(r["text"], r["shard"]) for r in found}) == len({r["text"] for r in found})


def plain_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_run_gives_what_the_stages_give(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = corpus_pipeline.run(spark, DATA)
    assert out.columns[: len(docs.columns)] == docs.columns and 0 < out.count() <= 3 * docs.count()
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, DATA)
    assert empty.count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_match_sql(spark, name):
    assert compare(spark, connect(DATA), DATA, name, queries.QUERIES[name], queries.ORACLE[name]) == ""


def test_every_operator_has_a_query():
    assert {n.split("_")[0] for n in queries.QUERIES if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
