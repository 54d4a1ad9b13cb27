"""Benchmark decontamination by winnowing.

Words are ASCII letters, digits and non-ASCII characters, A-Z lower-cased. A benchmark window is `window` consecutive words of an item, or all
words of a shorter item. Texts and items are fingerprinted: of each run of `window` words the least hash of its `k`-word
grams is kept, so whatever `window` words a text shares with an item, both keep the same fingerprint of them. The
fingerprints are joined; each match is extended to the benchmark windows that chose it, which are confirmed by the hash of
all their words. A shorter item of n words is its own fingerprint (grams of n words, each kept); only lengths that occur are looked for.

Each fingerprint of a text carries the hashes of the windows that chose it, so a match is extended without reading the text
again. Only matches are kept beyond the join with the benchmark's fingerprints, whose side the planner broadcasts
only if the written table is below its limit.

Rows are told apart by id and text hash, so repeated rows get the same result, once each. A NULL or empty text or item
has no words and hits nothing; a benchmark without words leaves all documents clean. Input columns travel in no join, so their names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.llm.joins import key_side
from tabml.llm.tokens import ALNUM, Words, lists, pieces, whole, windows, words_of
from tabml.sources.scratch import stored

WINDOW, GRAM = 13, 5


def winnowed(w: Words, window: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each whole window: its first word, its hash, and the position of the gram it chooses (the last of the least)."""
    inside = whole(w, window)
    first = np.flatnonzero(inside)
    grams = windows(w.hash, k)
    least, at = grams[first], first.copy()
    for j in range(1, window - k + 1):
        other = grams[first + j]
        better = other <= least
        least[better], at[better] = other[better], first[better] + j
    return first, windows(w.hash, window)[first], at


def _marks(w: Words, window: int, k: int, short: list[int]) -> tuple[np.ndarray, ...]:
    """Fingerprints of a piece, ordered by text: text, fingerprint, words per window; bounds, first words and hashes of its windows."""
    first, value, at = winnowed(w, window, k)
    fresh = np.ones(len(at), bool)
    fresh[1:] = at[1:] != at[:-1]  # windows that choose the same gram follow each other
    begin = np.flatnonzero(fresh)
    print_of, text, size = windows(w.hash, k)[at[begin]], w.text[first[begin]], np.full(len(begin), window)
    bounds, start, whole_hash = np.append(begin, len(at)), first, value
    for n in short:
        own = np.flatnonzero(whole(w, n))
        hashes = windows(w.hash, n)[own]
        print_of, text, size = np.concatenate([print_of, hashes]), np.concatenate([text, w.text[own]]), np.concatenate([size, np.full(len(own), n)])
        bounds = np.concatenate([bounds, bounds[-1] + 1 + np.arange(len(own))])
        start, whole_hash = np.concatenate([start, own]), np.concatenate([whole_hash, hashes])
    return text, print_of, size, bounds, start - w.bounds[w.text[start]] if len(start) else start, whole_hash


def _item_windows(window: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column(1)):
                part = batch.slice(a, b - a)
                w = words_of(part.column(1), ALNUM)
                count = np.diff(w.bounds)
                # a short item is looked at under its own length only
                text, prints, size, bounds, _, value = _marks(w, window, k, sorted({int(c) for c in count if 0 < c < window}))
                own = (size == window) | (size == count[text])
                row = np.repeat(np.arange(len(text)), np.diff(bounds))
                kept = own[row]
                row, value = row[kept], value[kept]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(text[row])), pa.array(size[row], pa.int32()), pa.array(prints[row].view(np.int64)), pa.array(value.view(np.int64))],
                    ["item", "size", "print", "value"],
                )

    return run


def _text_prints(window: int, k: int, short: list[int]):
    """One row per text with its number of words (`mark`), and one per fingerprint with the windows that chose it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column(2)):
                part = batch.slice(a, b - a)
                w = words_of(part.column(2), ALNUM)
                text, prints, size, bounds, start, value = _marks(w, window, k, short)
                n, m = b - a, len(text)
                row = np.concatenate([np.arange(n), text])
                bounds = np.concatenate([np.zeros(n, np.int64), bounds])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(row)),
                        part.column(1).take(pa.array(row)),
                        pa.array(np.concatenate([np.ones(n, bool), np.zeros(m, bool)])),
                        pa.array(np.concatenate([np.diff(w.bounds), size]), pa.int64()),
                        pa.array(np.concatenate([w.hash[w.bounds[:-1] % max(len(w.hash), 1)] if len(w.hash) else np.zeros(n, np.uint64), prints]).view(np.int64)),
                        lists(start.astype(np.int32), bounds, pa.int32()),
                        lists(value.view(np.int64), bounds, pa.int64()),
                    ],
                    ["id", "th", "mark", "size", "print", "starts", "values"],
                )

    return run


def contamination(df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, k: int = GRAM) -> DataFrame:
    """`(id, th, n_words, n_hit, items)` for each distinct id and text (`th`: xxhash64 of it), with `copies`, its number of rows.

    `n_hit`: words inside an occurrence of a benchmark window; `items`: the item ids with occurring windows, sorted as strings.
    """
    given = benchmark.select(F.col(f"`{item}`").cast("string").alias("item"), F.col(f"`{item_text}`").alias("text"))
    found = stored(given.mapInArrow(_item_windows(window, k), "item string, size int, print long, value long"), "items")
    prints = stored(found.select(F.col("print").alias("known"), F.col("size").alias("its_size")).distinct(), "prints")
    spans = stored(found.groupBy("value", "size").agg(F.array_sort(F.collect_set("item")).alias("items")), "spans")
    short = sorted(r["size"] for r in found.where(F.col("size") < window).select("size").distinct().collect())

    docs = df.select(F.col(f"`{key}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("th"), F.col(f"`{text}`").alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    rows = docs.mapInArrow(_text_prints(window, k, short), f"id {kind}, th long, mark boolean, size long, print long, starts array<int>, values array<long>")
    matched = rows.join(prints, (F.col("print") == F.col("known")) & (F.col("size") == F.col("its_size")), "left")
    matched = stored(matched.where(F.col("mark") | F.col("known").isNotNull()).drop("known", "its_size"), "matched")

    base = matched.where("mark").groupBy("id", "th").agg(F.max("size").alias("n_words"), F.count(F.lit(1)).alias("copies"))
    opened = matched.where(~F.col("mark")).select("id", "th", "size", F.explode(F.arrays_zip("starts", "values")).alias("w"))
    opened = opened.select("id", "th", F.col("size").cast("int").alias("size"), F.col("w.starts").alias("start"), F.col("w.values").alias("value"))
    hits = opened.join(spans, ["value", "size"])
    covered = F.array_distinct(F.flatten(F.collect_set(F.sequence(F.col("start"), F.col("start") + F.col("size") - 1))))
    by_text = hits.groupBy(F.col("id").alias("hit_id"), F.col("th").alias("hit_th")).agg(
        F.size(covered).cast("long").alias("n_hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")
    )
    joined = base.join(by_text, (F.col("th") == F.col("hit_th")) & F.col("id").eqNullSafe(F.col("hit_id")), "left")
    none = F.array().cast("array<string>")
    return joined.select("id", "th", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", none).alias("items"), "copies")


def is_contaminated(n_hit, n_words):
    """At least one word in twenty lies inside a benchmark window."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def decontaminated(df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `df` that aren't contaminated, with all their columns."""
    found = contamination(df, benchmark, key, text)
    gone = stored(found.where(is_contaminated(F.col("n_hit"), F.col("n_words"))).select("id", "th"), "gone")
    rows = df.select(F.struct("*").alias("row"), F.col(f"`{key}`").alias("key"), F.xxhash64(F.col(f"`{text}`")).alias("hash"))
    return rows.join(key_side(gone), (F.col("hash") == F.col("th")) & F.col("key").eqNullSafe(F.col("id")), "left_anti").select("row.*")
