"""Registered queries of the corpus operators: whole tables, production parameters, thin digests of the results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.llm import decontam, language, linededup, lm, mixing, neardup, oracle, quality, quotes, sharding, toxicity, trie, urls, whitening
from tabml.operators.ordering import running_totals
from tabml.sources.scratch import stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def turning_weights(sources: list) -> dict:
    """Weights 5, 2, 1 in turn over the sorted sources."""
    return {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judged(table(spark, sf_dir, "documents"), carry=["doc_id"])
    q = F.col("q")
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        *(q[c].alias(c) for c in ("n_words", "word_chars", "n_symbols")),
        q["lines"]["dup"].alias("n_dup_lines"),
        q["n_repeat_words"].alias("n_repeat_words"),
        "base_failed",
        "kept",
    )


@query
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.crc32("text").alias("text_crc32"))
    found = sharding.sharded(docs, 24, carry=["doc_id", "text_crc32"], key=["doc_id"])
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "size",
        F.col("row.text_crc32").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mix = mixing.mixed(docs, F.array("source"), turning_weights, mixing.word_count(F.col("text")), key=["doc_id", "text"], carry=["doc_id"])
    return mix.rows.select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", "taken")


@query
def op6_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), percent=85)
    return found.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept")
    )


@query
def op4_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    found = decontam.contamination(docs, items)
    one_each = found.select("*", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
    return one_each.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontam.is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


@query
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = language.held_out(F.col("doc_id"), 5, 0)
    names, protos = language.prototypes(docs.where(~held))
    found = language.predicted(docs.select("doc_id", "text"), names, protos, carry=["doc_id"])
    return found.select(F.col("row.doc_id").alias("doc_id"), language.held_out(F.col("row.doc_id"), 5, 0).alias("held_out"), "lang_pred", "score")


@query
def op8_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = lm.scored(docs, ~language.held_out(F.col("doc_id"), 10, 0))
    return found.select(
        F.col("id").alias("doc_id"), language.held_out(F.col("id"), 10, 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weight = toxicity.fitted(docs, table(spark, sf_dir, "labels"), ~language.held_out(F.col("doc_id"), 3, 1))
    found = toxicity.scored(docs, weight, carry=["doc_id"])
    held = language.held_out(F.col("row.doc_id"), 3, 1)
    return found.select(F.col("row.doc_id").alias("doc_id"), held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


URL_RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}


@query
def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = urls.judged(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES, carry=["page_id"])
    return found.select(F.col("row.page_id").alias("page_id"), "host", "path", "rule", "verdict")


@query
def op1_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.threaded(table(spark, sf_dir, "conversations"))


#: Messages that quote the one before them, from the third on also what that one quoted, and each fifth only some words of it, wrapped anew; for Spark and DuckDB alike.
REPLIES = """select conv_id, turn, role,
 case when prev is null then text
 when turn % 5 = 4 then concat('> ', {two}, ' ', {three}, chr(10), '> ', {four}, ' ', {five}, chr(10), text)
 when turn % 3 = 0 then concat(text, chr(10), '> ', replace(prev, chr(10), concat(chr(10), '> ')), chr(10), 'thanks')
 when prev2 is null then concat('user wrote:', chr(10), '> ', replace(prev, chr(10), concat(chr(10), '> ')), chr(10), text)
 else concat('user wrote:', chr(10), '> ', replace(prev, chr(10), concat(chr(10), '> ')), chr(10), '> > ', replace(prev2, chr(10), concat(chr(10), '> > ')), chr(10), text) end as text
 from {rows}"""
_WORDS = {w: f"split_part(replace(prev, chr(10), ' '), ' ', {i})" for i, w in enumerate(("two", "three", "four", "five"), 2)}
_LAGGED = """(select *, lag(text) over w as prev, lag(text, 2) over w as prev2 from conversations
 window w as (partition by conv_id order by turn nulls first, role nulls first, text nulls first)) t"""


def with_previous(df: DataFrame) -> DataFrame:
    """`conv_id, turn, role, text` with the texts of the two messages before, `prev` and `prev2`; turns are numbered by ranges, so no conversation is sorted in one task."""
    said = df.select("conv_id", "turn", "role", "text")
    placed = stored(running_totals(said, ["conv_id"], ["turn", "role", "text"], {"pos": F.lit(1).cast("long")}), "placed")
    found = placed
    for name, back in (("prev", 1), ("prev2", 2)):
        before = placed.select(F.col("conv_id").alias("its_conv"), (F.col("pos") + back).alias("its_pos"), F.col("text").alias(name))
        found = found.join(before, (F.col("pos") == F.col("its_pos")) & F.col("conv_id").eqNullSafe(F.col("its_conv")), "left").drop("its_conv", "its_pos")
    return found


@query
def chat_quoted_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotation linking over conversations in which replies quote: `conversations` has no quotation marks."""
    rows = with_previous(table(spark, sf_dir, "conversations"))
    return quotes.threaded(spark.sql(REPLIES.format(rows="{rows}", **_WORDS), rows=rows))


@query
def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = trie.numbered_turns(table(spark, sf_dir, "conversations"))
    return trie.prefix_trie(trie.with_shared_starts(turns))


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whitened(table(spark, sf_dir, "embeddings"), carry=["vec_id"])
    return found.select(F.col("row.vec_id").alias("vec_id"), "component", "n", "deviation", "whitened", "explained", "identity_error")


@query
def op13_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"), carry=["doc_id"])
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE |= {
    "op1_quotes": oracle.quotes("select * from conversations"),
    "op3_mixing": oracle.mixing(),
    "op4_decontam": oracle.decontam(),
    "op6_neardup": oracle.neardup(),
    "op10_quality": oracle.quality(),
    "op11_trie": oracle.trie(),
    "op13_linededup": oracle.line_dedup(),
    "chat_quoted_replies": oracle.quotes(REPLIES.format(rows=_LAGGED, **_WORDS)),
}
