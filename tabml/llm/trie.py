"""Prefix trie of conversations: one node per distinct sequence of first turns, counted by ROLLUP over blocks of turns.

A conversation is cut into blocks of `BLOCK` turns. A row per conversation and block holds its turn ids in columns `t1` to `t8` and the key
of the node that the blocks before it lead to. `GROUP BY block, prior node, ROLLUP (t1, ..., t8)` then counts all prefixes of all
lengths at once: `grouping_id()` tells how many turns of the block a group keeps, and a group whose last kept turn is missing is no node.

* A turn id is 128 bits of hash of role and text, with the text's length. A node's key is its depth and two sums of 62-bit hashes of
  (turn id, position), so the keys of a node and of its parent are expressions of a block's row: no chain is walked.
* The smallest member of a node owns it. Down a path the owner can only grow, so the nodes of one owner are consecutive depths:
  a *path*. `(owner, depth)` names a node, and only the first node of a path has to look its parent up by key.
* Sums over subtrees are sums over paths that hang on each other. Paths are summed by pointer doubling (rounds: the logarithm of how
  deep paths hang on paths), and within a path by running totals, which cut a very long one into ranges.
* Conversations that end at a node are hashed in order: sorted ranges are written as pieces of text, and the pieces of a node
  stream through one hasher. A node where a third of all conversations end needs as little memory as any other.

Defined results: NULL roles and texts are empty; turns with the same number are ordered by role and text; rows without a conversation id
belong to none; repeated rows are turns of their own; an empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabml.llm.joins import key_side
from tabml.operators.ordering import running_totals
from tabml.sources.scratch import stored

BLOCK = 8
PIECE = 1 << 20
NO_ENDS = hashlib.sha256(b"").hexdigest()
_TURNS = [f"t{k}" for k in range(1, BLOCK + 1)]


def numbered_turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """`(conv, pos, h1, h2, chars)`: turns as ids, numbered from 1 in each conversation; written to the shared folder."""
    said = df.where(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").cast("long").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    placed = running_totals(said, ["conv"], ["turn", "role", "text"], {"pos": F.lit(1).cast("long")})
    return stored(
        placed.select("conv", "pos", F.xxhash64("role", "text").alias("h1"), F.xxhash64("text", F.lit(11), "role").alias("h2"), F.length("text").cast("long").alias("chars")),
        "turns",
    )


def with_shared_starts(turns: DataFrame, group: int = 100, starts: int = 6) -> DataFrame:
    """Conversations rebuilt: the first h turns of conversation c - c % group, then c's own turns after its first h; h = crc32(c) % starts.

    `(conv, pos, h1, h2, chars)`, and a row with `pos` 0 for each conversation, also one without turns.
    """
    sizes = turns.groupBy("conv").agg(F.max("pos").alias("n"))
    convs = sizes.select("conv", (F.col("conv") - F.col("conv") % group).alias("base"), (F.crc32(F.col("conv").cast("string")) % starts).alias("h"))
    convs = convs.join(sizes.select(F.col("conv").alias("base"), F.col("n").alias("n_base")), "base", "left")
    convs = stored(convs.withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0)))), "rebuilt")
    first = turns.where(F.col("pos") < starts).withColumnRenamed("conv", "base")
    begun = key_side(convs.where("taken > 0")).join(first, "base").where("pos <= taken").select("conv", "pos", "h1", "h2", "chars")
    rest = turns.join(key_side(convs.select("conv", "h", "taken")), "conv").where("pos > h")
    rest = rest.select("conv", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "h1", "h2", "chars")
    return begun.unionByName(rest).unionByName(beginnings(convs))


def beginnings(convs: DataFrame) -> DataFrame:
    """The row with `pos` 0 that stands for a conversation's beginning."""
    return convs.select("conv", F.lit(0).cast("long").alias("pos"), *[F.lit(0).cast("long").alias(c) for c in ("h1", "h2", "chars")])


def _part(seed: int, one: Column, two: Column, pos: Column) -> Column:
    """What a turn at a position adds to the key: 62 bits of hash; decimals hold the sum of any number of these."""
    return F.when(one.isNull() | (pos <= 0), F.lit(0)).otherwise(F.shiftrightunsigned(F.xxhash64(F.lit(seed), one, two, pos), 2)).cast("decimal(20,0)")


def blocks_of(turns: DataFrame) -> DataFrame:
    """`(conv, block, p1, p2, k1, k2, t1, ...)` per conversation and block of turns: key sums before and behind the block, its turns."""
    pos = F.col("pos")
    place = pos - F.col("block") * BLOCK
    one = F.struct("h1", "h2", "chars")
    parts = [F.max(F.when(place == k + 1, one)).alias(t) for k, t in enumerate(_TURNS)]
    sums = [F.sum(_part(s, F.col("h1"), F.col("h2"), pos)).cast("decimal(38,0)").alias(f"s{s}") for s in (1, 2)]
    block = F.greatest(F.lit(0).cast("long"), F.floor((pos - 1) / BLOCK)).alias("block")
    rows = turns.select("*", block).groupBy("conv", "block").agg(*parts, *sums, F.max("pos").alias("upto"))
    rows = running_totals(stored(rows, "blocks"), ["conv"], ["block"], {"k1": F.col("s1"), "k2": F.col("s2")})
    before = [(F.col(f"k{s}") - F.col(f"s{s}")).cast("decimal(38,0)").alias(f"p{s}") for s in (1, 2)]
    return rows.select("conv", "block", *before, *[F.col(f"k{s}").cast("decimal(38,0)").alias(f"k{s}") for s in (1, 2)], "upto", *_TURNS)


def counted_nodes(blocks: DataFrame) -> DataFrame:
    """`(conv, depth, n_convs, chars, k1, k2, u1, u2)` per node: owner, members, length of its last text, its key and its parent's."""
    names = ", ".join(_TURNS)
    rolled = blocks.sparkSession.sql(
        f"""select block, p1, p2, {names}, cast({BLOCK} - bit_count(grouping_id()) as int) as kept, min(conv) as conv, count(*) as n_convs
        from {{blocks}} group by block, p1, p2, rollup({names})""",
        blocks=blocks,
    )
    kept, last = F.col("kept"), F.coalesce(*[F.when(F.col("kept") == k + 1, F.col(t)) for k, t in enumerate(_TURNS)])
    depth = F.col("block") * BLOCK + kept
    rolled = rolled.where(((kept == 0) & (F.col("block") == 0)) | last.isNotNull())

    def key(s: int) -> Column:
        return sum((_part(s, F.col(t)["h1"], F.col(t)["h2"], F.col("block") * BLOCK + k + 1) for k, t in enumerate(_TURNS)), F.col(f"p{s}")).cast("decimal(38,0)")

    own = [key(s).alias(f"k{s}") for s in (1, 2)]
    up = [(key(s) - _part(s, last["h1"], last["h2"], depth)).cast("decimal(38,0)").alias(f"u{s}") for s in (1, 2)]
    return rolled.select("conv", depth.alias("depth"), "n_convs", F.coalesce(last["chars"], F.lit(0)).alias("chars"), *own, *up)


def _summed_paths(paths: DataFrame) -> DataFrame:
    """`(conv, all_saved, all_leaves)`: sums over each path and all that hang on it, by pointer doubling.

    After k rounds a path holds the sums of the paths less than 2**k steps below it, and points 2**k steps up.
    """
    state = paths.select("conv", "up", F.col("saved").alias("all_saved"), F.col("leaf").cast("long").alias("all_leaves"))
    while not state.where("up is not null").isEmpty():
        low = state.where("up is not null")
        added = low.groupBy(F.col("up").alias("conv")).agg(F.sum("all_saved").alias("s"), F.sum("all_leaves").alias("l"))
        above = low.join(state.select(F.col("conv").alias("up"), F.col("up").alias("far")), "up").where("far is not null").select("conv", "far")
        state = state.join(added, "conv", "left").join(above, "conv", "left")
        state = stored(
            state.select(
                "conv",
                F.col("far").alias("up"),
                (F.col("all_saved") + F.coalesce("s", F.lit(0))).alias("all_saved"),
                (F.col("all_leaves") + F.coalesce("l", F.lit(0))).alias("all_leaves"),
            ),
            "paths",
        )
    return state.select("conv", "all_saved", "all_leaves")


def _end_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of one node as comma-joined pieces of text."""
    held, node, first, size = [], None, None, 0
    out, waiting = [], 0  # pieces that wait for a full batch, and their length

    def closed() -> dict:
        return {"depth": node[0], "k1": node[1], "k2": node[2], "first": first, "piece": ",".join(held)}

    for batch in batches:
        for *key, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and (key != node or size > PIECE):
                out.append(closed())
                waiting += size
                held, size = [], 0
                if len(out) > 4096 or waiting > PIECE:
                    yield pa.RecordBatch.from_pylist(out, schema=_PIECES)
                    out, waiting = [], 0
            if not held:
                node, first = key, conv
            held.append(str(conv))
            size += len(held[-1]) + 1
    if held:
        yield pa.RecordBatch.from_pylist([*out, closed()], schema=_PIECES)


_KEY = [("depth", pa.int64()), ("k1", pa.decimal128(38, 0)), ("k2", pa.decimal128(38, 0))]
_PIECES = pa.schema([*_KEY, ("first", pa.int64()), ("piece", pa.string())])
_DIGESTS = pa.schema([*_KEY, ("ends_sha256", pa.string())])
_KEY_SQL = "depth long, k1 decimal(38,0), k2 decimal(38,0)"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node from its pieces in order, a batch of digests at a time."""
    node, hasher, out = None, None, []

    def closed() -> dict:
        return {"depth": node[0], "k1": node[1], "k2": node[2], "ends_sha256": hasher.hexdigest()}

    for batch in batches:
        for *key, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key == node:
                hasher.update(b"," + piece.encode())
                continue
            if node is not None:
                out.append(closed())
            node, hasher = key, hashlib.sha256(piece.encode())
        if len(out) > 4096:
            yield pa.RecordBatch.from_pylist(out, schema=_DIGESTS)
            out = []
    if node is not None:
        yield pa.RecordBatch.from_pylist([*out, closed()], schema=_DIGESTS)


def ends_by_node(blocks: DataFrame) -> DataFrame:
    """`(depth, k1, k2, ends_sha256)` of nodes at which conversations end."""
    behind = F.max(F.struct("block", "upto", "k1", "k2"))
    ends = blocks.groupBy("conv").agg(behind.alias("e")).select(F.col("e.upto").alias("depth"), "e.k1", "e.k2", "conv")
    order = ["depth", "k1", "k2", "conv"]
    pieces = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_end_pieces, f"{_KEY_SQL}, first long, piece string")
    held = pieces.repartition(*order[:3]).sortWithinPartitions(*order[:3], "first")
    return held.select(*order[:3], "piece").mapInArrow(_digests, f"{_KEY_SQL}, ends_sha256 string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per node `(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)`.

    `turns`: `(conv, pos, h1, h2, chars)` with positions from 1 without gaps, and a row with `pos` 0 per conversation.
    """
    blocks = stored(blocks_of(turns), "prefixes")
    nodes = stored(counted_nodes(blocks), "nodes")
    saved = (F.col("n_convs") - 1) * F.col("chars")
    paths = nodes.groupBy("conv").agg(F.min(F.struct("depth", "u1", "u2")).alias("top"), F.max("depth").alias("end"), F.sum(saved).alias("saved"))
    paths = paths.select("conv", (F.col("top.depth") - 1).alias("up_depth"), F.col("top.u1").alias("k1"), F.col("top.u2").alias("k2"), "end", "saved")
    parents = nodes.select(F.col("conv").alias("up"), F.col("depth").alias("up_depth"), "k1", "k2")
    paths = stored(paths.join(parents, ["up_depth", "k1", "k2"], "left").select("conv", "up", "up_depth", "end", "saved"), "paths")
    hung = paths.where("up is not null").groupBy(F.col("up").alias("conv"), F.col("up_depth").alias("depth")).agg(F.count(F.lit(1)).alias("hung"))
    ends = paths.join(hung.select("conv", F.col("depth").alias("end"), "hung"), ["conv", "end"], "left").withColumn("leaf", F.col("hung").isNull())
    paths = stored(paths.join(_summed_paths(ends), "conv"), "summed")

    below = paths.where("up is not null").groupBy(F.col("up").alias("conv"), F.col("up_depth").alias("depth")).agg(
        F.count(F.lit(1)).alias("hung"), F.sum("all_saved").alias("s"), F.sum("all_leaves").alias("l")
    )
    met = nodes.join(below, ["conv", "depth"], "left").join(key_side(paths.select("conv", "up", "up_depth", "end", "all_saved", "all_leaves")), "conv")
    ending = F.col("depth") == F.col("end")
    here = {
        "s": saved + F.coalesce("s", F.lit(0)),
        "l": F.coalesce("l", F.lit(0)) + (ending & F.col("hung").isNull()).cast("long"),
    }
    met = stored(
        met.select(
            "conv",
            "depth",
            F.when(F.col("depth") == F.col("up_depth") + 1, F.col("up")).otherwise(F.col("conv")).alias("parent"),
            "n_convs",
            (F.coalesce("hung", F.lit(0)) + (~ending).cast("long")).alias("n_children"),
            *["all_saved", "all_leaves", "k1", "k2"],
            *[v.alias(k) for k, v in here.items()],
        ),
        "met",
    )
    # what is on the path from this node on: all of the path without what comes before
    summed = running_totals(met, ["conv"], ["depth"], {"upto_s": F.col("s"), "upto_l": F.col("l")})
    summed = summed.join(ends_by_node(blocks), ["depth", "k1", "k2"], "left")
    return summed.select(
        F.col("conv").alias("conv_id"),
        F.col("depth").cast("long").alias("depth"),
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        (F.col("all_leaves") - F.col("upto_l") + F.col("l")).alias("n_leaves"),
        (F.col("all_saved") - F.col("upto_s") + F.col("s")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
