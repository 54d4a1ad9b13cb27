"""Language identification by hyperdimensional profiles.

Each letter has a random vector of -1 and 1, drawn from its code point. An n-gram is the product (binding) of its
letters' vectors, each rolled by its position in the n-gram (permutation). The n-gram vectors of a text add up
(bundling) to its vector; the vectors of all texts of a language add up to the language's prototype. A text gets the
language whose prototype has the largest cosine with its vector.

Letters are lower-cased; a run of anything else counts as one blank, also before and after the text. Partial
prototypes are summed in the tasks, so learning ships one vector per language and task; only the prototypes
(languages x dimensions) reach the driver and the tasks. All sums are whole numbers, so results don't depend on partitions.

Defined results: a text that is NULL or has no letter is `und` with score 0, and so is every text if nothing can be learned. Ties go to the
language first by code point. Negative cosines count as 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabml.llm.tokens import pieces

DIMENSIONS, GRAM, PIECE, PIECE_ROWS = 1024, 3, 1 << 20, 512
UNKNOWN = "und"
_BLANK = 32


@lru_cache(1)
def _fold() -> np.ndarray:
    """Lower-case letter of each code point; a blank for everything that isn't a letter."""
    table = np.full(0x110000, _BLANK, np.uint32)
    for c in range(0x110000):
        if chr(c).isalpha():
            low = chr(c).lower()
            table[c] = ord(low[0])
    return table


def letter_vector(letter: int, dimensions: int) -> np.ndarray:
    rng = np.random.Generator(np.random.PCG64([letter, 17]))
    return (rng.integers(0, 2, dimensions, dtype=np.int8) * 2 - 1).astype(np.float32)


def gram_counts(texts: list[str | None], n: int) -> tuple[np.ndarray, np.ndarray]:
    """How often each text has each of the distinct n-grams, and these n-grams (rows of n letters)."""
    fold = _fold()
    # Each text stands behind a line break, its mark, and runs of blanks are cut to one.
    joined = "\n" + "\n".join((t or "").replace("\n", " ") for t in texts) + "\n"
    raw = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    mark, letters = raw == 10, fold[raw]
    blank = letters == _BLANK
    kept = ~blank | mark
    kept[1:] |= ~blank[:-1]
    letters, mark = letters[kept], mark[kept]
    last = np.zeros(len(mark), bool)  # a blank of its own behind the last letter of a text; the next mark stands for it
    last[:-1] = (letters[:-1] == _BLANK) & ~mark[:-1] & mark[1:]
    letters, mark = letters[~last], mark[~last]
    owner, size = np.cumsum(mark) - 1, len(mark) - n + 1
    if size <= 0:
        return np.zeros((len(texts), 0), np.float32), np.zeros((0, n), np.int64)
    inner = np.zeros(size, bool)  # a mark may be the first or the last blank of an n-gram only
    for j in range(1, n - 1):
        inner |= mark[j : j + size]
    alphabet, code = np.unique(letters, return_inverse=True)
    gram = np.zeros(size, np.int64)
    for j in range(n):
        gram = gram * len(alphabet) + code[j : j + size]
    gram, of = gram[~inner], owner[:size][~inner]
    if len(alphabet) ** n <= 1 << 22:
        seen = np.flatnonzero(np.bincount(gram))
        at = np.zeros(len(alphabet) ** n, np.int64)
        at[seen] = np.arange(len(seen))
        at = at[gram]
    else:
        seen, at = np.unique(gram, return_inverse=True)
    grams = np.stack([alphabet[seen // len(alphabet) ** (n - 1 - j) % len(alphabet)] for j in range(n)], axis=1).astype(np.int64)
    counts = np.bincount(of * len(seen) + at, minlength=len(texts) * len(seen)).reshape(len(texts), len(seen)).astype(np.float32)
    letter = (grams != _BLANK).any(axis=1)
    return counts[:, letter], grams[letter]


class Encoder:
    """Vectors of n-grams; those met before are kept, up to `MOST` at a time."""

    MOST = 1 << 14

    def __init__(self, dimensions: int, n: int):
        self.dimensions, self.n = dimensions, n
        self.known: dict[tuple, int] = {}
        self.vectors = np.zeros((0, dimensions), np.float32)

    def grams(self, grams: np.ndarray) -> np.ndarray:
        keys = list(map(tuple, grams.tolist()))
        new = [k for k in keys if k not in self.known]
        if new:
            if len(self.known) + len(new) > self.MOST:
                self.known, self.vectors, new = {}, self.vectors[:0], keys
            drawn = {c: letter_vector(c, self.dimensions) for c in {c for k in new for c in k}}
            made = np.ones((len(new), self.dimensions), np.float32)
            for j in range(self.n):
                rolled = {c: np.roll(v, j) for c, v in drawn.items()}
                for row, k in zip(made, new, strict=True):
                    row *= rolled[k[j]]
            self.known |= {k: len(self.known) + i for i, k in enumerate(new)}
            self.vectors = np.concatenate([self.vectors, made])
        return self.vectors[[self.known[k] for k in keys]]

    def bundles(self, counts: np.ndarray, grams: np.ndarray) -> np.ndarray:
        """Vectors of texts or classes from their n-gram counts; cut by n-grams, so that memory stays bounded."""
        out = np.zeros((len(counts), self.dimensions))
        for a in range(0, len(grams), 8192):
            out += counts[:, a : a + 8192] @ self.grams(grams[a : a + 8192])
        return out


def _learn(dimensions: int, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, total = Encoder(dimensions, n), {}
        for batch in batches:
            for a, b in pieces(batch.column(1), PIECE, PIECE_ROWS):
                langs, texts = batch.column(0)[a:b].to_pylist(), batch.column(1)[a:b].to_pylist()
                names = sorted(set(langs))
                counts, grams = gram_counts(texts, n)
                of = np.array(langs)
                for name, v in zip(names, encoder.bundles(np.stack([counts[of == x].sum(axis=0) for x in names]), grams), strict=True):
                    total[name] = total.get(name, 0) + v
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array([v.astype(np.int64) for v in total.values()], pa.list_(pa.int64()))], ["lang", "v"])

    return run


def prototypes(df: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS, n: int = GRAM) -> tuple[list[str], np.ndarray]:
    """Languages by code point and their prototypes, from all rows of `df` with a language and a text."""
    given = df.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")
    parts = given.mapInArrow(_learn(dimensions, n), "lang string, v array<long>")
    summed = parts.select("lang", F.posexplode("v")).groupBy("lang", "pos").agg(F.sum("col").alias("v"))
    found = summed.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("pos", "v"))).alias("v")).select("lang", "v.v").collect()
    found = sorted((r for r in found if any(r["v"])), key=lambda r: r["lang"])
    return [r["lang"] for r in found], np.array([r["v"] for r in found], float).reshape(len(found), dimensions)


def cosines(texts: list[str | None], encoder: Encoder, unit: np.ndarray, n: int) -> np.ndarray:
    """Cosine of each text with each unit prototype; -2 for texts without letters."""
    counts, grams = gram_counts(texts, n)
    own = encoder.bundles(counts, grams)
    length = np.sqrt((own * own).sum(axis=1))
    out = (own @ unit.T) / np.maximum(length, 1e-12)[:, None]
    out[counts.sum(axis=1) == 0] = -2
    return out


def predicted(df: DataFrame, names: list[str], protos: np.ndarray, text: str = "text", carry: list[str] | None = None, n: int = GRAM) -> DataFrame:
    """The columns `carry` (all by default) in a struct `row`, with `lang_pred` and `score`."""
    unit = protos / np.maximum(np.sqrt((protos * protos).sum(axis=1)), 1e-12)[:, None]
    model = df.sparkSession.sparkContext.broadcast((names, unit))
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in (df.columns if carry is None else carry))).alias("row"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, unit = model.value
        encoder = Encoder(unit.shape[1], n)
        labels = [UNKNOWN, *names]
        for batch in batches:
            for a, b in pieces(batch.column(1), PIECE, PIECE_ROWS):
                if names:
                    cos = cosines(batch.column(1)[a:b].to_pylist(), encoder, unit, n)
                    best, top = cos.argmax(axis=1), cos.max(axis=1)
                else:
                    best, top = np.zeros(b - a, int), np.full(b - a, -2.0)
                pick = np.where(top < -1.5, 0, best + 1)
                pred = pa.array([labels[i] for i in pick], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], pred, pa.array(np.clip(top, 0.0, 1.0))], ["row", "lang_pred", "score"])

    row = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {row}, lang_pred string, score double")


def held_out(key: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the key, as text, leaves the remainder `part` by `parts`; a NULL key counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(parts)) == part
