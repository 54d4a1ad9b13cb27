"""Lines that many documents share are dropped everywhere but in the first document that holds them.

A text is split at newlines; a NULL or empty text is one empty line. A line's key is the line without white space (bytes 9 to 13 and 32)
at both ends, A-Z lower-cased. Keys of at least `shortest` code points that occur in at least `at_least` documents lose
their lines in all documents but the one with the smallest id; other lines stay in place, joined by newlines again.

* Every line of a text is hashed to 128 bits by array operations inside tasks; the hashes are exploded with the id, the text's hash and the position.
* Per hash the distinct documents are counted. For `at_least=2` the smallest and the largest id tell that, so that
  one combined row per task and hash is shuffled; for more, pairs of hash and id are made distinct first. A line that
  a third of all documents hold is never gathered.
* Lines are joined with the counted hashes (`key_side`), and what is dropped is gathered per text: at most the text's own
  positions. Texts take part in one join only, with the positions dropped; that side is broadcast while it is small.

Documents are told apart by id. Rows with the same id are one document when documents are counted; equal rows get equal results, once
each. A NULL id is a document of its own, later than all others. An empty table gives no rows. Input columns travel in a struct, so names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabml.llm.joins import MOST_KEYS, key_side
from tabml.llm.tokens import SPACED, _buffers, mixed, pieces
from tabml.sources.scratch import stored

SHORTEST, AT_LEAST = 10, 2
# Bytes of text at a time: a dozen arrays of eight bytes for each of these are held at once, and the powers for good.
PIECE_BYTES = 1 << 18
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEPS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_VALUES = np.random.Generator(np.random.PCG64(513)).integers(0, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, list[np.ndarray]] = {}


def _power(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first `n` powers of an odd number and of its inverse, modulo 2**64."""
    held = _powers.get(which)
    if held is None or len(held[0]) < n:
        held = []
        for base in (int(_STEPS[which]), pow(int(_STEPS[which]), -1, 1 << 64)):
            grown = np.full(n, np.uint64(base))
            grown[0] = 1
            held.append(np.multiply.accumulate(grown))
        _powers[which] = held
    return held[0][:n], held[1][:n]


def span_hashes(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Two independent hashes of each byte range `first[i]:last[i]`; ranges are in order and don't overlap."""
    out = np.zeros((2, len(first)), np.uint64)
    a = 0
    while a < len(first):  # a piece of ranges at a time
        b = max(a + 1, int(np.searchsorted(last, first[a] + PIECE_BYTES, side="right")))
        low, high = int(first[a]), int(last[b - 1])
        for k in range(2):
            power, inverse = _power(k, max(1, high - low + 1))
            total = np.zeros(high - low + 1, np.uint64)
            np.cumsum(_VALUES[k][data[low:high]] * power[: high - low], out=total[1:])
            out[k, a:b] = (total[last[a:b] - low] - total[first[a:b] - low]) * inverse[first[a:b] - low]
        a = b
    return mixed(out + (last - first).astype(np.uint64))


def lines_of(column: pa.Array) -> tuple[np.ndarray, ...]:
    """Lines of a piece: bounds per text, first and end byte of each, and of its key, code points of the key, the lower-cased bytes."""
    bounds, raw = _buffers(column)
    data = _LOWER[raw]
    breaks = np.flatnonzero(raw == 10)
    # each text begins a line, and so does each byte behind a newline
    per_text = np.searchsorted(breaks, bounds[1:]) - np.searchsorted(breaks, bounds[:-1]) + 1
    line_bounds = np.concatenate([[0], np.cumsum(per_text)])
    first, end = np.empty(line_bounds[-1], np.int64), np.empty(line_bounds[-1], np.int64)
    opening = np.zeros(line_bounds[-1], bool)
    opening[line_bounds[:-1]] = True
    first[opening], first[~opening] = bounds[:-1], breaks + 1
    closing = np.zeros(line_bounds[-1], bool)
    closing[line_bounds[1:] - 1] = True
    end[closing], end[~closing] = bounds[1:], breaks
    inner = np.flatnonzero(SPACED[data])
    low, high = np.searchsorted(inner, first), np.searchsorted(inner, end)
    empty = low == high
    spot = np.append(inner, 0)
    key_first = np.where(empty, first, spot[np.where(empty, 0, low)])
    key_end = np.where(empty, first, spot[np.where(empty, 0, high - 1)] + 1)
    begun = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return line_bounds, first, end, key_first, key_end, begun[key_end] - begun[key_first], data


def _hashed(shortest: int):
    """One row per line that is long enough to be dropped: id, text hashes, position, line hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column(3), PIECE_BYTES):
                part = batch.slice(a, b - a)
                bounds, _, _, low, high, size, data = lines_of(part.column(3))
                kept = np.flatnonzero(size >= shortest)
                one, two = span_hashes(data, low[kept], high[kept])
                text = np.searchsorted(bounds, kept, side="right") - 1
                owner = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(i).take(owner) for i in range(3)),
                        pa.array((kept - bounds[text]).astype(np.int32)),
                        pa.array(one.view(np.int64)),
                        pa.array(two.view(np.int64)),
                    ],
                    ["id", "t1", "t2", "pos", "k1", "k2"],
                )

    return run


def shared_keys(lines: DataFrame, at_least: int = AT_LEAST) -> DataFrame:
    """`(k1, k2, keeper)`: hashes that at least `at_least` documents hold, and the smallest id among these."""
    keys = ["k1", "k2"]
    if at_least <= 2:
        ends = lines.groupBy(*keys).agg(F.min("id").alias("keeper"), F.max("id").alias("most"), F.max(F.col("id").isNull()).alias("nameless"))
        n = F.when(F.col("keeper").isNull(), 0).when(F.col("keeper") == F.col("most"), 1).otherwise(2) + F.col("nameless").cast("int")
        return ends.where(n >= at_least).select(*keys, "keeper")
    once = lines.groupBy(*keys, "id").agg(F.lit(1).alias("one"))
    counted = once.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("keeper"))
    return counted.where(F.col("n") >= at_least).select(*keys, "keeper")


def dropped_lines(lines: DataFrame, at_least: int = AT_LEAST) -> DataFrame:
    """`(id, t1, t2, dropped array<int>)` for each distinct text that loses lines."""
    keys = key_side(stored(shared_keys(lines, at_least), "shared-lines"))
    gone = lines.join(keys, ["k1", "k2"]).where(~F.col("id").eqNullSafe(F.col("keeper")))
    return gone.groupBy("id", "t1", "t2").agg(F.collect_set("pos").alias("dropped"))


def _reassembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the lines at the positions dropped."""
    for batch in batches:
        for a, b in pieces(batch.column(1), PIECE_BYTES):
            part = batch.slice(a, b - a)
            texts, gone = part.column(1), part.column(2)
            bounds, first, end, *_ = lines_of(texts)
            keep = np.ones(len(first), bool)
            gone_of = np.repeat(np.arange(b - a), gone.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            keep[bounds[gone_of] + gone.flatten().to_numpy(zero_copy_only=False)] = False
            raw = _buffers(texts)[1]
            # every kept line keeps its newline, the last line of a text gets one for the cut
            sizes = np.where(keep, end - first + 1, 0)
            owner = np.repeat(np.arange(b - a), np.diff(bounds))
            n_kept = np.bincount(owner, keep, b - a).astype(np.int64)
            length = np.bincount(owner, sizes, b - a).astype(np.int64)
            out_ends = np.cumsum(length)
            at = np.cumsum(sizes) - sizes
            out = np.full(int(out_ends[-1]) if len(out_ends) else 0, 10, np.uint8)
            rows = np.flatnonzero(keep & (end > first))
            span = end[rows] - first[rows]
            shift = np.repeat(at[rows] - first[rows], span)
            source = np.arange(span.sum()) + np.repeat(first[rows] - (np.cumsum(span) - span), span)
            out[source + shift] = raw[source]
            data = out.tobytes()
            starts = out_ends - length
            made = [data[s : e - 1].decode() if k else "" for s, e, k in zip(starts.tolist(), out_ends.tolist(), n_kept.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.diff(bounds), pa.int64()), pa.array(np.diff(bounds) - n_kept, pa.int64()), pa.array(made, pa.string())],
                ["row", "n_lines", "n_dropped", "kept_text"],
            )


def deduplicated(
    df: DataFrame, text: str = "text", key: str = "doc_id", shortest: int = SHORTEST, at_least: int = AT_LEAST, carry: Sequence[str] | None = None
) -> DataFrame:
    """`(row, n_lines, n_dropped, kept_text)` per row of `df`; `row` holds the input columns (those in `carry`)."""
    carried = F.struct(*[F.col(f"`{c}`") for c in (df.columns if carry is None else carry)])
    value, one, two = _keys(F.col(f"`{text}`"))
    docs = df.select(carried.alias("row"), F.col(f"`{key}`").alias("id"), one.alias("t1"), two.alias("t2"), value.alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    lines = docs.select("id", "t1", "t2", "text").mapInArrow(_hashed(shortest), f"id {kind}, t1 long, t2 long, pos int, k1 long, k2 long")
    gone = stored(dropped_lines(stored(lines, "lines"), at_least), "dropped")
    size = gone.agg(F.sum(F.size("dropped") + 3)).first()[0] or 0
    side = F.broadcast(gone) if size <= MOST_KEYS else gone
    same = F.col("d.id").eqNullSafe(F.col("g.id")) & (F.col("d.t1") == F.col("g.t1")) & (F.col("d.t2") == F.col("g.t2"))
    met = docs.alias("d").join(side.alias("g"), same, "left").select("d.row", "d.text", "g.dropped")
    fields = [docs.schema["row"], T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()), T.StructField("kept_text", T.StringType())]
    return met.mapInArrow(_reassembled, T.StructType(fields))


def _keys(text: Column) -> tuple[Column, Column, Column]:
    value = F.coalesce(text, F.lit(""))
    return value, F.xxhash64(value), F.xxhash64(F.lit(13), value)
