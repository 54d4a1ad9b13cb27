"""Language model scores: a log-bilinear model over word classes, trained with noise-contrastive estimation.

Words between white space, A-Z lower-cased, then an end token. The `top` most frequent words are classes of their own; every other word is, by
its last two bytes, in one of `tail` rest classes. Both numbers grow with the root of the number of distinct words. From the vectors of the classes of
the two tokens before, each multiplied by a matrix of its place and added, comes the class; a word then has its smoothed
share of its class's training counts, unseen words together one share per rest class:
P(word | before) = P(class | before) * P(word | class), which sums to 1.

* Counts cover all training texts. Each task counts its words, Spark sums them. The `HEAD` most frequent words go to all
  tasks as a sorted array; every other word of a text is joined with its count by a shuffle. The network goes to all tasks: `WIDTH`
  numbers twice for each class.
* Training examples are the counted class triples of all training tokens, so they grow with the corpus and no token is left out. They travel as packed
  arrays in buckets of their hashes, where they are summed and ordered by a second hash. A learner, at most `LEARNERS` of them, is one task that
  learns some of the buckets block by block in numpy, weighing each triple by its count, and what the learners found is averaged after each of `ROUNDS`
  rounds. Neither examples nor their order depend on how the texts are partitioned. Few triples are repeated.
* The normaliser of a context of two classes is a sum over classes of products of two exponentials, one for each place, so all of them are one matrix product.
  Tasks make it band by band, and it goes to all tasks as a table of at most `MOST_CONTEXTS` numbers, which holds the classes with the largest masses; contexts with
  another class are normalised one by one. A token is then a lookup and one dot product.

Scores are log10. They don't depend on partitions beyond the rounding of sums. Words are told apart by 64-bit hashes. A NULL text is an empty one: it has only
the end token. Repeated rows are scored one by one. Without training texts every word is unseen and the classes are equally likely.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabml.llm.tokens import SPACED, Words, distinct_pairs, lists, mixed, pieces, words_of
from tabml.sources.scratch import stored

HEAD = 1 << 18
LEAST_TOP, LEAST_TAIL = 512, 48
KINDS = 1 << 16  # rest words by their last two bytes, before these are dealt to the rest classes
WIDTH, BATCH, NOISE = 16, 512, 32
LEARNERS, ROUNDS, RATE = 32, 2, 0.1
SHARE_BITS, BUCKET_BITS, CHUNK = 20, 21, 1 << 17  # triples of a learner, tokens of a bucket, triples learned in one drawn order
LEAST_EXAMPLES, MOST_TIMES = 1 << 19, 200  # how often few triples are repeated
MOST_CONTEXTS, BAND = 1 << 26, 256  # contexts in the table of normalisers, rows of it made at once
SURE = 1e-25  # sums below it may have lost terms to underflow
END = np.uint64(0x1F83D9ABFB41BD6B)
ADD = 0.1


def with_ends(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, Words]:
    """Tokens of a piece, each text's end among them: their texts, hashes and kinds (-1 for an end)."""
    w = words_of(column, SPACED)
    n = len(column)
    last = w.data[w.last - 1].astype(np.uint64) if len(w.last) else np.zeros(0, np.uint64)
    before = np.where(w.last - w.first > 1, w.data[np.maximum(w.last - 2, 0)], 0).astype(np.uint64) if len(w.last) else last
    kind = (mixed(last * np.uint64(257) + before) % np.uint64(KINDS)).astype(np.int32)
    place = np.arange(len(w.hash)) + w.text
    ends = w.bounds[1:] + np.arange(n)
    text, value, kinds = np.zeros(len(w.hash) + n, np.int64), np.zeros(len(w.hash) + n, np.uint64), np.zeros(len(w.hash) + n, np.int32)
    text[place], value[place], kinds[place] = w.text, w.hash, kind
    text[ends], value[ends], kinds[ends] = np.arange(n), END, -1
    return text, value, kinds, w


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the words of a task, given out whenever they have become many."""
    held, size = [], 0

    def given() -> pa.RecordBatch:
        value, at = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
        n, kind = np.bincount(at, np.concatenate([h[1] for h in held])).astype(np.int64), np.zeros(len(value), np.int64)
        kind[at] = np.concatenate([h[2] for h in held])
        return pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(n), pa.array(kind, pa.int32())], ["h", "c", "kind"])

    for batch in batches:
        for a, b in pieces(batch.column(0)):
            _, value, kind, _ = with_ends(batch.column(0)[a:b])
            value, at, n = np.unique(value, return_index=True, return_counts=True)
            held.append((value, n, kind[at]))
            size += len(value)
            if size > 2_000_000:
                yield given()
                held, size = [], 0
    if held:
        yield given()


@dataclass
class Vocabulary:
    """The most frequent words, sorted by hash, with counts and classes; the total and the distinct; numbers of classes.

    Classes are the `top` words by frequency, the rest classes, and the end token.
    """

    value: np.ndarray
    count: np.ndarray
    cls: np.ndarray
    total: int
    distinct: int
    top: int
    tail: int
    weight: np.ndarray  # log10 of the smoothed counts
    taken: np.ndarray  # smoothed counts that the words with a class of their own take from the rest classes

    @property
    def classes(self) -> int:
        return self.top + self.tail + 1

    def find(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each hash is among the words held here, and where."""
        if not len(self.value):
            return np.zeros(len(value), bool), np.zeros(len(value), np.int64)
        at = np.searchsorted(self.value, value)
        at[at == len(self.value)] = 0
        return self.value[at] == value, at

    def of_kind(self, kind: np.ndarray) -> np.ndarray:
        return np.where(kind < 0, self.classes - 1, self.top + kind % self.tail)

    def classes_of(self, kind: np.ndarray, known: np.ndarray, at: np.ndarray) -> np.ndarray:
        cls = self.of_kind(kind)
        return np.where(known, self.cls[at], cls) if len(self.cls) else cls


def class_numbers(distinct: int) -> tuple[int, int]:
    """Own classes and rest classes for a number of distinct words."""
    root = int(distinct**0.5)
    return max(LEAST_TOP, root + root // 4), max(LEAST_TAIL, root // 4)


def vocabulary(counts: DataFrame) -> tuple[Vocabulary, DataFrame]:
    """The head of the counts (`h, c, kind`) for all tasks, and the rest as a table `(h, c)`.

    Counts are put on a fine logarithmic scale; the head is all words above the lowest step that leaves at most `HEAD`.
    """
    step = F.floor(F.log2("c") * 16)
    steps = sorted(((r["step"], r["n"]) for r in counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    edge, size = 1 << 30, 0
    for at, n in steps:
        size += n
        if size > HEAD:
            break
        edge = at
    head = counts.where(step >= edge).toArrow().to_pandas().sort_values(["c", "h"], ascending=[False, True], ignore_index=True)
    sums = counts.agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).first()
    top, tail = class_numbers(int(sums["v"]))
    rank = head[head.kind >= 0].index[:top]
    top = len(rank)
    value, count = head.h.to_numpy(np.int64).view(np.uint64), head.c.to_numpy(np.int64)
    found = Vocabulary(value, count, np.zeros(0, np.int64), int(sums["c"] or 0), int(sums["v"]), top, tail, np.log10(count + ADD), np.zeros(top + tail + 1))
    cls = found.of_kind(head.kind.to_numpy(np.int64))
    np.add.at(found.taken, cls[rank], count[rank] + ADD)
    cls[rank] = np.arange(top)
    by = np.argsort(value)
    found.value, found.count, found.cls, found.weight = value[by], count[by], cls[by], found.weight[by]
    return found, counts.where(step < edge).select("h", "c")


def class_masses(counts: DataFrame, vocab: Vocabulary) -> np.ndarray:
    """Smoothed training counts of each class, those of unseen words among them."""
    out = np.zeros(vocab.classes)
    np.add.at(out, vocab.cls, vocab.count + ADD)
    found = counts.groupBy("kind").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).toArrow()
    kind = found["kind"].to_numpy()
    whole = np.zeros(vocab.classes)
    np.add.at(whole, vocab.of_kind(kind), found["c"].to_numpy() + ADD * found["v"].to_numpy())
    out[vocab.top :] = whole[vocab.top :] - vocab.taken[vocab.top :]
    out[vocab.top : -1] += ADD
    out[-1] = max(out[-1], ADD)
    return out


def contexts(text: np.ndarray, cls: np.ndarray, begin: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the first and second token before each token; `begin` before the beginning."""
    one, two = np.full(len(cls), begin), np.full(len(cls), begin)
    one[1:] = np.where(text[1:] == text[:-1], cls[:-1], begin)
    two[2:] = np.where(text[2:] == text[:-2], cls[:-2], begin)
    return one, two


@dataclass
class Model:
    """`parts`: vectors of the classes as context (and of the beginning), as prediction, a matrix for each place before, biases."""

    parts: list[np.ndarray]
    log_noise: np.ndarray  # logarithm of the noise distribution: the classes' shares of the training tokens

    @property
    def classes(self) -> int:
        return len(self.log_noise)

    def context_vectors(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        before, _, place, _ = self.parts
        return (before @ place[0])[one] + (before @ place[1])[two]

    def normalisers(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """log of the sum over all classes, per context, by batches of matrix products."""
        _, after, _, bias = self.parts
        out = np.empty(len(one), np.float32)
        for a in range(0, len(one), 4 * BATCH):
            score = self.context_vectors(one[a : a + 4 * BATCH], two[a : a + 4 * BATCH]) @ after.T
            score += bias
            most = score.max(axis=1)
            score -= most[:, None]
            out[a : a + 4 * BATCH] = most + np.log(np.exp(score, out=score).sum(axis=1))
        return out

    def band(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """`normalisers` of each of `one` before each of `two`: the exponentials of both places are taken apart, and a matrix product sums over the classes."""
        before, after, place, bias = self.parts
        first, most_first = _exponentials((before @ place[0])[one], after, bias)
        out = np.empty((len(one), len(two)), np.float32)
        for a in range(0, len(two), BAND):
            second, most_second = _exponentials((before @ place[1])[two[a : a + BAND]], after, 0)
            total = first @ second.T
            row, at = np.nonzero(~(total >= SURE))
            part = out[:, a : a + BAND]
            part[:] = np.log(np.maximum(total, SURE)) + most_first[:, None] + most_second
            if len(row):
                part[row, at] = self.normalisers(one[row], two[a + at])
        return out


def _exponentials(vectors: np.ndarray, after: np.ndarray, bias: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """exp of each vector's scores less their largest, and the largest."""
    score = vectors @ after.T
    score += bias
    most = score.max(axis=1)
    score -= most[:, None]
    return np.exp(score, out=score), most


def fresh_model(masses: np.ndarray, seed: int = 1) -> Model:
    rng = np.random.Generator(np.random.PCG64(seed))
    k = len(masses)
    share = (masses / masses.sum()).astype(np.float32)
    parts = [rng.normal(0, 0.1, (k + 1, WIDTH)), rng.normal(0, 0.1, (k, WIDTH)), np.stack([np.eye(WIDTH), np.eye(WIDTH) / 2]), np.log(share)]
    return Model([p.astype(np.float32) for p in parts], np.log(share))


class Learner:
    """One copy of the network in one round: noise-contrastive estimation with a rate of its own for each row."""

    def __init__(self, model: Model, rate: float, seed: int):
        self.model, self.rate, self.rng = model, rate, np.random.Generator(np.random.PCG64(seed))
        self.parts = [p.copy() for p in model.parts]
        self.squares = [np.full(p.shape if k == 2 else len(p), 1e-3, np.float32) for k, p in enumerate(self.parts)]
        self.edges = np.cumsum(np.exp(model.log_noise))
        self.scaled = model.log_noise + np.float32(np.log(NOISE))
        self.slot = np.zeros(len(self.parts[0]), np.int64)

    def learn(self, two: np.ndarray, one: np.ndarray, own: np.ndarray, count: np.ndarray) -> None:
        order = self.rng.permutation(len(own))
        for a in range(0, len(own), BATCH):
            rows = order[a : a + BATCH]
            self._batch(two[rows], one[rows], own[rows], count[rows])

    def _batch(self, two: np.ndarray, one: np.ndarray, own: np.ndarray, count: np.ndarray) -> None:
        before, after, place, bias = self.parts
        weight = (count / count.sum()).astype(np.float32)
        first, second = before[one], before[two]
        q = first @ place[0] + second @ place[1]
        noise = np.minimum(np.searchsorted(self.edges, self.rng.random(NOISE)), len(bias) - 1)
        data = np.einsum("nd,nd->n", q, after[own]) + bias[own] - self.scaled[own]
        other = q @ after[noise].T + (bias[noise] - self.scaled[noise])
        d_data = weight / (1 + np.exp(data))
        d_other = -weight[:, None] / (1 + np.exp(-other))
        d_q = d_data[:, None] * after[own] + d_other @ after[noise]
        both = np.concatenate([own, noise])
        self._add(0, np.concatenate([one, two]), np.concatenate([d_q @ place[0].T, d_q @ place[1].T]))
        self._add(1, both, np.concatenate([d_data[:, None] * q, d_other.T @ q]))
        turned = np.stack([first.T @ d_q, second.T @ d_q])
        self.squares[2] += turned * turned
        place += self.rate * turned / np.sqrt(self.squares[2])
        rows, both = self._met(both)
        grad = np.bincount(both, np.concatenate([d_data, d_other.sum(axis=0)]), len(rows)).astype(np.float32)
        self.squares[3][rows] += grad * grad
        bias[rows] += self.rate * grad / np.sqrt(self.squares[3][rows])

    def _met(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows met, and for each place the position of its row in them; without work on the other rows, which grow with the words."""
        self.slot[at] = np.arange(len(at))
        rows = at[self.slot[at] == np.arange(len(at))]
        self.slot[rows] = np.arange(len(rows))
        return rows, self.slot[at]

    def _add(self, k: int, at: np.ndarray, grad: np.ndarray) -> None:
        """Sum the gradients by row, then step by the root of the squares met by the row."""
        rows, at = self._met(at)
        total = np.bincount((at[:, None] * WIDTH + np.arange(WIDTH)).ravel(), grad.ravel(), len(rows) * WIDTH).astype(np.float32).reshape(-1, WIDTH)
        self.squares[k][rows] += (total * total).mean(axis=1)
        self.parts[k][rows] += (self.rate / np.sqrt(self.squares[k][rows]))[:, None] * total


def _triples(words, buckets: int):
    """Counted class triples `(two, one, class)` of a task as packed arrays per bucket of hashes, given out whenever they have become many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = words.value
        n, held, size = vocab.classes, [], 0

        def given() -> pa.RecordBatch:
            code, count = _merged(held)
            bucket = _bucket(code, buckets)
            order = np.argsort(bucket, kind="stable")
            bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
            full = np.flatnonzero(np.diff(bounds))
            code, count = code[order], count[order]
            columns = [[x[bounds[k] : bounds[k + 1]].tobytes() for k in full] for x in (code, count)]
            return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), *(pa.array(x, pa.binary()) for x in columns)], ["bucket", "code", "c"])

        for batch in batches:
            for a, b in pieces(batch.column(0)):
                text, value, kind, _ = with_ends(batch.column(0)[a:b])
                cls = vocab.classes_of(kind, *vocab.find(value))
                one, two = contexts(text, cls, n)
                code, count = np.unique((two * (n + 1) + one) * n + cls, return_counts=True)
                held.append((code, count.astype(np.int32)))
                size += len(held[-1][0])
                if size > 4_000_000:
                    yield given()
                    held, size = [], 0
        if held:
            yield given()

    return run


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and their summed counts; the list is emptied, so that nothing is held twice."""
    code, count = (np.concatenate(x) for x in zip(*held))
    held.clear()
    order = np.argsort(code)
    code, count = code[order], count[order]
    begin = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
    return code[begin], np.add.reduceat(count, begin).astype(np.int32)


def _bucket(code: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(code.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)


_BLOCK = "bucket int, seq int, n int, code binary, c binary"


def _merged_bucket(table: pa.Table) -> pa.Table:
    """The distinct triples of one bucket in the order of a second hash, cut into blocks."""
    code, count = _merged([(np.frombuffer(c.as_py(), np.int64), np.frombuffer(n.as_py(), np.int32)) for c, n in zip(table["code"], table["c"], strict=True)])
    order = np.argsort(mixed(mixed(code.astype(np.uint64)) + np.uint64(7)))
    code, count = code[order], count[order]
    at = range(0, len(code), CHUNK)
    return pa.table(
        {
            "bucket": pa.array([table["bucket"][0].as_py()] * len(at), pa.int32()),
            "seq": pa.array(range(len(at)), pa.int32()),
            "n": pa.array([len(code[a : a + CHUNK]) for a in at], pa.int32()),
            "code": pa.array([code[a : a + CHUNK].tobytes() for a in at], pa.binary()),
            "c": pa.array([count[a : a + CHUNK].tobytes() for a in at], pa.binary()),
        }
    )


def counted_triples(texts: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Blocks of distinct counted triples; a bucket gets at most some `2**BUCKET_BITS` of the training tokens' triples."""
    words, buckets = texts.sparkSession.sparkContext.broadcast(vocab), (vocab.total >> BUCKET_BITS) + 1
    parts = texts.mapInArrow(_triples(words, buckets), "bucket int, code binary, c binary")
    return stored(parts.groupBy("bucket").applyInArrow(_merged_bucket, _BLOCK), "triples")


def _learn(sent, turn: int):
    """Learners over blocks of triples in order of learner; each gives its changed arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        n = model.classes
        now, learner = None, None

        def closed() -> pa.RecordBatch:
            parts = [p.astype(np.float32).tobytes() for p in learner.parts]
            return pa.RecordBatch.from_arrays([pa.array([now] * 4, pa.int32()), pa.array(range(4), pa.int32()), pa.array(parts, pa.binary())], ["learner", "part", "value"])

        for batch in batches:
            for who, whole, code, count in zip(*(batch.column(i) for i in range(4)), strict=True):
                if who.as_py() != now:
                    if learner is not None:
                        yield closed()
                    now = who.as_py()
                    learner = Learner(model, RATE * (1 - turn / ROUNDS), turn * LEARNERS + now)
                code, count = np.frombuffer(code.as_py(), np.int64), np.frombuffer(count.as_py(), np.int32)
                for _ in range(max(1, min(MOST_TIMES, LEAST_EXAMPLES // whole.as_py()))):
                    learner.learn(code // n // (n + 1), code // n % (n + 1), code % n, count)
        if learner is not None:
            yield closed()

    return run


def learned(model: Model, triples: DataFrame) -> Model:
    """The network after all rounds over the blocks of triples; after each, the mean of the learners' networks."""
    size = triples.agg(F.sum("n")).first()[0] or 0
    learners = max(1, min(LEARNERS, size >> SHARE_BITS))
    dealt = triples.select(F.pmod("bucket", F.lit(learners)).alias("learner"), F.lit(-(-size // learners)).cast("long").alias("whole"), "code", "c", "bucket", "seq")
    ordered = dealt.repartitionByRange(learners, "learner").sortWithinPartitions("learner", "bucket", "seq").drop("bucket", "seq")
    context = triples.sparkSession.sparkContext
    for turn in range(ROUNDS):
        sent = context.broadcast(model)
        found = ordered.mapInArrow(_learn(sent, turn), "learner int, part int, value binary").toArrow().sort_by([("learner", "ascending")])
        parts = []
        for k, old in enumerate(model.parts):
            each = [np.frombuffer(v.as_py(), np.float32) for p, v in zip(found["part"], found["value"], strict=True) if p.as_py() == k]
            parts.append(np.mean(each, axis=0).reshape(old.shape) if each else old)
        model = Model(parts, model.log_noise)
        sent.destroy()
    return model


def tabled(masses: np.ndarray) -> np.ndarray:
    """Classes, the beginning among them, whose contexts get a place in the table of normalisers: those with the largest masses."""
    side, n = int(MOST_CONTEXTS**0.5), len(masses) + 1
    if n <= side:
        return np.arange(n)
    return np.sort(np.append(np.argsort(-masses, kind="stable")[: max(0, side - 1)], n - 1))[:side]


def normaliser_table(spark, model: Model, held: np.ndarray) -> np.ndarray:
    """The normalisers of all contexts of the classes `held`, made by tasks in bands of rows."""
    sent, bands = spark.sparkContext.broadcast((model, held)), -(-len(held) // BAND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, classes = sent.value
        for batch in batches:
            for k in batch.column(0).to_pylist():
                value = network.band(classes[k * BAND : (k + 1) * BAND], classes).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([value], pa.binary())], ["band", "value"])

    found = spark.range(0, bands, 1, max(1, bands)).mapInArrow(run, "band int, value binary").toArrow().sort_by("band")
    sent.destroy()
    return np.concatenate([np.frombuffer(v.as_py(), np.float32) for v in found["value"]] or [np.zeros(0, np.float32)]).reshape(len(held), len(held))


class Scorer:
    """Class probabilities with the table of normalisers of the classes `held`, made here where it isn't given."""

    def __init__(self, model: Model, masses: np.ndarray, held: np.ndarray | None = None, table: np.ndarray | None = None):
        before, self.after, place, self.bias = model.parts
        self.model, self.log_mass = model, np.log10(masses)
        self.one, self.two = before @ place[0], before @ place[1]
        self.n = model.classes + 1
        held = tabled(masses) if held is None else held
        self.table = model.band(held, held) if table is None else table
        self.slot = np.full(self.n, -1)
        self.slot[held] = np.arange(len(held))

    def normaliser(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        row, at = self.slot[one], self.slot[two]
        if len(self.table) == self.n:
            return self.table[row, at]
        out = np.empty(len(one), np.float32)
        known = (row >= 0) & (at >= 0)
        out[known] = self.table[row[known], at[known]]
        code, back = np.unique(one[~known] * self.n + two[~known], return_inverse=True)
        out[~known] = self.model.normalisers(code // self.n, code % self.n)[back]
        return out

    def log_shares(self, one: np.ndarray, two: np.ndarray, cls: np.ndarray) -> np.ndarray:
        """log10 P(class | one, two) without the log10 count of its class: what is added to the log10 count of a word."""
        score = np.einsum("nd,nd->n", self.one[one] + self.two[two], self.after[cls]) + self.bias[cls]
        return (score - self.normaliser(one, two)) / np.log(10) - self.log_mass[cls]


def _score(words, net):
    """Per text: tokens, those in the head, their sums of log10 counts and class shares, and the other words with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, scorer = words.value, Scorer(*net.value)
        for batch in batches:
            for a, b in pieces(batch.column(2)):
                part = batch.slice(a, b - a)
                text, value, kind, _ = with_ends(part.column(2))
                known, at = vocab.find(value)
                cls = vocab.classes_of(kind, known, at)
                share = scorer.log_shares(*contexts(text, cls, vocab.classes), cls)
                n = b - a
                log_head = np.where(known, vocab.weight[at] if len(vocab.weight) else 0.0, 0.0)
                out = ~known
                owner, word, count = distinct_pairs(text[out], value[out])
                bounds = np.searchsorted(owner, np.arange(n + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(np.bincount(text, minlength=n), pa.int64()),
                        pa.array(np.bincount(text, known, n).astype(np.int64)),
                        pa.array(np.bincount(text, log_head, n)),
                        pa.array(np.bincount(text, share, n)),
                        lists(word.view(np.int64), bounds, pa.int64()),
                        lists(count, bounds, pa.int64()),
                    ],
                    ["id", "th", "n_tokens", "n_head", "log_head", "log_share", "words", "times"],
                )

    return run


def fitted(texts: DataFrame) -> tuple[Vocabulary, DataFrame, Model, np.ndarray]:
    """The vocabulary, the counts of the words beyond it, the network and the class masses, from the training texts (`text`)."""
    counts = texts.mapInArrow(_count, "h long, c long, kind int").groupBy("h").agg(F.sum("c").alias("c"), F.min("kind").alias("kind"))
    counts = stored(counts, "counts")
    vocab, rest = vocabulary(counts)
    masses = class_masses(counts, vocab)
    return vocab, rest, learned(fresh_model(masses), counted_triples(texts, vocab)), masses


def scored(df: DataFrame, learn: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`(id, th, n_tokens, n_known, train_tokens, base_score, score)` per row of `df`; rows where `learn` holds train the model.

    `base_score`: log10 probability of the text by smoothed word counts; `score`: by the model; `th`: xxhash64 of the text.
    """
    spark = df.sparkSession
    vocab, rest, model, masses = fitted(df.where(learn).select(F.col(f"`{text}`").alias("text")))
    held = tabled(masses)
    words, net = spark.sparkContext.broadcast(vocab), spark.sparkContext.broadcast((model, masses, held, normaliser_table(spark, model, held)))

    docs = df.select(F.col(f"`{key}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("th"), F.col(f"`{text}`").alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    fields = f"id {kind}, th long, n_tokens long, n_head long, log_head double, log_share double, words array<long>, times array<long>"
    parts = docs.mapInArrow(_score(words, net), fields).withColumn("row", F.monotonically_increasing_id())
    parts = stored(parts, "scored")
    opened = parts.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select("row", F.col("w.words").alias("h"), F.col("w.times").alias("n"))
    met = opened.join(rest.withColumnRenamed("c", "found"), "h", "left")
    tail = met.groupBy("row").agg(F.sum(F.when(F.col("found").isNotNull(), F.col("n")).otherwise(0)).alias("n_tail"), F.sum(F.col("n") * F.log10(F.coalesce("found", F.lit(0)) + ADD)).alias("log_tail"))
    joined = parts.join(tail, "row", "left")
    log_counts = F.col("log_head") + F.coalesce("log_tail", F.lit(0.0))
    scale = float(np.log10(vocab.total + ADD * (vocab.distinct + 1)))
    return joined.select(
        "id",
        "th",
        "n_tokens",
        (F.col("n_head") + F.coalesce("n_tail", F.lit(0))).alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        (log_counts - F.col("n_tokens") * F.lit(scale)).alias("base_score"),
        (log_counts + F.col("log_share")).alias("score"),
    )
