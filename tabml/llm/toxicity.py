"""Toxicity by multiple-instance learning: sentences score, a noisy-or combines them, document labels train.

A sentence ends at a full stop, an exclamation or question mark, or a line break. Its score is the logistic of the sum of the
weights of its distinct words; a document is toxic unless all its sentences are clean: 1 - product(1 - p). The gradient of the document
loss goes to the sentences in proportion to their share, so the model finds the offending ones by itself.

The classifier learns from at most `SAMPLE` labelled documents, those with the least hashes of their ids; the sample of
labels is the broadcast side, its bound is that number of rows. Scoring covers all documents within their rows; only the
weights (`2**BITS` numbers) reach the tasks.

Defined results: a NULL or empty text has no sentence and scores 0. Labels that are NULL, or of a NULL id, are not used; of several labels
of an id the largest counts. Without labels of both kinds the start weights remain: all scores are low.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabml.llm.tokens import ALNUM, lists, pieces, words_of
from tabml.sources.scratch import stored

SAMPLE, BITS = 16_000, 18
ROUNDS, BATCH, RATE, DECAY = 30, 64, 1.0, 1e-5
#: Logit of a sentence without evidence: so low that even thousands of clean sentences leave a document clean.
START = -10.0
#: A word is evidence if it is in three sample documents and its share of toxic documents exceeds the others' by so many standard errors.
LEAST_DOCS, LEAST_Z = 3, 3.7
_END = np.zeros(256, bool)
_END[[10, 33, 46, 63]] = True


def sentences_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a piece: the feature and the sentence of each word, the text of each sentence, and its byte range in the text."""
    w = words_of(column, ALNUM)
    if not len(w.hash):
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros((0, 2), np.int64)
    ends = np.concatenate([[0], np.cumsum(_END[w.data])])[w.first]
    fresh = np.ones(len(ends), bool)
    fresh[1:] = (ends[1:] != ends[:-1]) | (w.text[1:] != w.text[:-1])
    begin = np.flatnonzero(fresh)
    last = np.append(begin[1:], len(fresh)) - 1
    origin = _starts(column)[w.text[begin]]
    spans = np.stack([w.first[begin] - origin, w.last[last] - origin], axis=1)
    return (w.hash >> np.uint64(64 - BITS)).astype(np.int64), np.cumsum(fresh) - 1, w.text[begin], spans


def _starts(column: pa.Array) -> np.ndarray:
    sizes = np.array(pa.compute.binary_length(column.fill_null("")), np.int64)
    return np.cumsum(sizes) - sizes


@dataclass
class Bags:
    """Labelled documents as word features by sentence by document; `word_at[s]`, `sentence_at[d]` are bounds."""

    words: np.ndarray
    word_at: np.ndarray
    sentence_at: np.ndarray
    label: np.ndarray

    def part(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words, their sentences and the documents of these, for some documents."""
        sentences = np.concatenate([np.arange(self.sentence_at[d], self.sentence_at[d + 1]) for d in docs] or [np.zeros(0, int)])
        of = np.repeat(np.arange(len(docs)), self.sentence_at[docs + 1] - self.sentence_at[docs])
        sizes = self.word_at[sentences + 1] - self.word_at[sentences]
        at = np.repeat(self.word_at[sentences] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        return self.words[at], np.repeat(np.arange(len(sentences)), sizes), of


def noisy_or(z: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """-log of the chance that a document is clean, and the sentences' scores, from their logits."""
    return np.bincount(of, np.logaddexp(0, z), n), 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def once(words: np.ndarray, sentence: np.ndarray, useful: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Useful words, each once per sentence: the distinct words, the index of each pair's word, and its sentence."""
    found = useful[words]
    pair = np.unique((sentence[found] << BITS) | words[found])
    distinct, at = np.unique(pair & ((1 << BITS) - 1), return_inverse=True)
    return distinct, at, pair >> BITS


def evidence(bags: Bags) -> np.ndarray:
    """Which words occur in clearly more toxic documents than in others."""
    within = [np.zeros(1 << BITS), np.zeros(1 << BITS)]
    for d, label in enumerate(bags.label):
        a, b = bags.word_at[bags.sentence_at[d]], bags.word_at[bags.sentence_at[d + 1]]
        within[int(label > 0)][np.unique(bags.words[a:b])] += 1
    toxic = max(1, int((bags.label > 0).sum()))
    clean = max(1, len(bags.label) - toxic)
    share = (within[0] + within[1]) / (toxic + clean)
    error = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / toxic + 1 / clean))
    return (within[0] + within[1] >= LEAST_DOCS) & (within[1] / toxic - within[0] / clean > LEAST_Z * error)


def train(bags: Bags, rounds: int = ROUNDS, seed: int = 3) -> np.ndarray:
    """Weights of the words by AdaGrad on the noisy-or log loss; words that are no evidence keep weight 0."""
    weight = np.zeros(1 << BITS)
    n = len(bags.label)
    if not n or bags.label.min() == bags.label.max():
        return weight
    useful = evidence(bags)
    rng = np.random.Generator(np.random.PCG64(seed))
    squares = np.full(1 << BITS, 1e-4)
    for _ in range(rounds):
        for docs in np.array_split(rng.permutation(n), max(1, n // BATCH)):
            words, sentence, of = bags.part(docs)
            distinct, at, sentence = once(words, sentence, useful)
            clean, p = noisy_or(np.bincount(sentence, weight[distinct][at], len(of)) + START, of, len(docs))
            clean = np.maximum(clean, 1e-9)
            slope = np.where(bags.label[docs] > 0, -np.exp(-clean) / -np.expm1(-clean), 1.0)
            dz = (slope[of] * p / len(docs))[sentence]
            g = np.bincount(at, dz, len(distinct)) + DECAY * weight[distinct]
            squares[distinct] += g * g
            weight[distinct] -= RATE * g / np.sqrt(squares[distinct])
    return weight


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in pieces(batch.column(2)):
            part = batch.slice(a, b - a)
            words, sentence, text, _ = sentences_of(part.column(2))
            sizes = np.bincount(sentence, minlength=len(text))
            word_bounds = np.searchsorted(text[sentence], np.arange(b - a + 1)) if len(words) else np.zeros(b - a + 1, int)
            sentence_bounds = np.searchsorted(text, np.arange(b - a + 1))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), lists(words.astype(np.int32), word_bounds, pa.int32()), lists(sizes.astype(np.int32), sentence_bounds, pa.int32())],
                ["id", "label", "words", "sizes"],
            )


def fitted(docs: DataFrame, labels: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> np.ndarray:
    """Weights from labelled documents; `learn` is a condition on the column `key` of `labels`."""
    known = labels.where(learn).where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("label_id")).agg(F.max(label).cast("int").alias("label"))
    drawn = stored(known.orderBy(F.xxhash64("label_id"), "label_id").limit(sample), "labels")
    joined = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text")).join(F.broadcast(drawn), F.col("id") == F.col("label_id"))
    kind = docs.schema[key].dataType.simpleString()
    rows = joined.select("id", "label", "text").mapInArrow(_features, f"id {kind}, label int, words array<int>, sizes array<int>").toArrow().sort_by("id").combine_chunks()
    words, sizes = (rows[c].combine_chunks() if isinstance(rows[c], pa.ChunkedArray) else rows[c] for c in ("words", "sizes"))
    flat = sizes.flatten().to_numpy().astype(np.int64)
    word_at = np.concatenate([[0], np.cumsum(flat)])
    counts = np.array(pa.compute.list_value_length(sizes), np.int64)
    bags = Bags(words.flatten().to_numpy(), word_at, np.concatenate([[0], np.cumsum(counts)]), np.array(rows["label"], np.int64))
    return train(bags)


def scored(df: DataFrame, weight: np.ndarray, text: str = "text", carry: list[str] | None = None, offending: float = 0.5) -> DataFrame:
    """Columns `carry` (all by default) in a struct `row`, with `score` and `sentences`: byte range and score of each offending sentence."""
    model = df.sparkSession.sparkContext.broadcast(weight)
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in (df.columns if carry is None else carry))).alias("row"), F.col(f"`{text}`").alias("text"))
    span = pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = model.value
        useful = weight != 0
        for batch in batches:
            for a, b in pieces(batch.column(1)):
                words, sentence, of, spans = sentences_of(batch.column(1)[a:b])
                distinct, at, sentence = once(words, sentence, useful)
                clean, p = noisy_or(np.bincount(sentence, weight[distinct][at], len(of)) + START, of, b - a)
                bad = np.flatnonzero(p >= offending)
                values = pa.StructArray.from_arrays([pa.array(spans[bad, 0]), pa.array(spans[bad, 1]), pa.array(p[bad])], fields=list(span))
                bounds = np.searchsorted(of[bad], np.arange(b - a + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], pa.array(-np.expm1(-clean)), pa.ListArray.from_arrays(pa.array(bounds), values)], ["row", "score", "sentences"])

    row = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {row}, score double, sentences array<struct<first:long,last:long,score:double>>")
