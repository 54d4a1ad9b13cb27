"""Near-duplicates by one-permutation MinHash with optimal densification, banded buckets and star-shaped candidates.

1. Each text becomes the set of its distinct word shingles (64-bit hashes). Texts with equal sets form one class, so
   copies are counted once from here on.
2. One hash of every shingle fills `bands * rows` bins with their least value. An empty bin takes the value of the first
   filled bin in a fixed random order of its own (optimal densification). `rows` bins form a band; classes that agree in a band share a bucket.
3. In every bucket all classes are paired with the smallest one only (a star), and each pair is confirmed on full sets.
4. A star can miss a link between two other classes of its bucket. Buckets that still hold several components are
   searched again: distances to the hub rule most pairs out, the others meet in blocks of bounded size, and pairs of different
   components are compared on full sets. Only confirmed links that join two components leave a task, so their number stays
   below the number of classes. No bucket is capped.

With 36 bands of 7 bins, two sets miss each other with a probability of about 1e-6 at a similarity of 0.85 and 2e-4 at 0.80.

Defined results: a NULL or empty text has no shingles and is linked with nothing. A NULL id counts as larger than
all others. Rows that repeat an id belong to the class of their own text. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.llm.joins import key_side
from tabml.llm.tokens import SPACED, distinct_pairs, lists, mixed, pieces, whole, windows, words_of
from tabml.operators.components import connected_components
from tabml.sources.scratch import stored

BANDS, ROWS = 36, 7
#: Members of a part of a star; classes and shingles of a block of a bucket.
CHUNK, BLOCK, BLOCK_SHINGLES = 64, 384, 500_000
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts of a piece, and the bounds of each text's set."""
    w = words_of(column, SPACED)
    inside = whole(w, k)
    hashes, owner = windows(w.hash, k)[inside], w.text[: len(inside)][inside]
    count = np.diff(w.bounds)
    few = np.flatnonzero((count > 0) & (count < k))
    if len(few):
        short = [windows(w.hash[w.bounds[t] : w.bounds[t + 1]], int(count[t])) for t in few]
        hashes, owner = np.concatenate([hashes, *short]), np.concatenate([owner, few])
    owner, hashes, _ = distinct_pairs(owner, hashes)
    return hashes, np.searchsorted(owner, np.arange(len(column) + 1))


def _orders(bins: int) -> np.ndarray:
    """For each bin a fixed random order of the bins, in which it looks for a filled one."""
    rng = np.random.Generator(np.random.PCG64(7))
    return np.argsort(rng.random((bins, bins)), axis=1)


def signatures(hashes: np.ndarray, bounds: np.ndarray, bands: int, rows: int, orders: np.ndarray) -> np.ndarray:
    """Band hashes of each set, one row per set; sets without shingles get arbitrary ones."""
    n, bins = len(bounds) - 1, bands * rows
    owner = np.repeat(np.arange(n), np.diff(bounds))
    g = mixed(hashes ^ np.uint64(0x5851F42D4C957F2D))
    spot = ((g >> np.uint64(40)) % np.uint64(bins)).astype(np.int64)
    least = np.full(n * bins, _EMPTY, np.uint64)
    np.minimum.at(least, owner * bins + spot, g & np.uint64((1 << 40) - 1))
    least = least.reshape(n, bins)
    full = least.copy()
    text, spot = np.nonzero((least == _EMPTY) & (np.diff(bounds) > 0)[:, None])
    for turn in range(bins):
        if not len(text):
            break
        value = least[text, orders[spot, turn]]
        found = value != _EMPTY
        full[text[found], spot[found]] = value[found]
        text, spot = text[~found], spot[~found]
    out = np.tile(mixed(np.arange(bands, dtype=np.uint64) + np.uint64(1)), (n, 1))
    for j in range(rows):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + full.reshape(n, bands, rows)[:, :, j])
    return out


def _sign(k: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = _orders(bands * rows)
        for batch in batches:
            for a, b in pieces(batch.column(2)):
                part = batch.slice(a, b - a)
                hashes, bounds = shingle_sets(part.column(2), k)
                total = np.zeros((2, len(hashes) + 1), np.uint64)
                np.cumsum(mixed(hashes), out=total[0, 1:])
                np.cumsum(mixed(hashes ^ np.uint64(0xA0761D6478BD642F)), out=total[1, 1:])
                sums = (total[:, bounds[1:]] - total[:, bounds[:-1]]).view(np.int64)
                band = signatures(hashes, bounds, bands, rows, orders).view(np.int64)
                wide = lists(band.ravel(), np.arange(b - a + 1) * bands, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(np.diff(bounds), pa.int64()), pa.array(sums[0]), pa.array(sums[1]), wide],
                    ["id", "th", "n", "s1", "s2", "bands"],
                )

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column(1)):
                part = batch.slice(a, b - a)
                hashes, bounds = shingle_sets(part.column(1), k)
                yield pa.RecordBatch.from_arrays([part.column(0), lists(hashes.view(np.int64), bounds, pa.int64())], ["cid", "set"])

    return run


def _set_of(batch: pa.RecordBatch, name: str) -> list[np.ndarray]:
    column = batch.column(batch.schema.get_field_index(name))
    at, values = column.offsets.to_numpy(), column.values.to_numpy().view(np.uint64)
    return [values[at[i] : at[i + 1]] for i in range(len(column))]


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets overlap by `percent` of their union at least."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = _overlap(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by star, its own set first: the intersection and the union of each member with it."""
    hub, own = None, None
    for batch in batches:
        hubs, members = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        found = []
        for a, b, s in zip(hubs, members, _set_of(batch, "set"), strict=True):
            if b is None:
                hub, own = a, s.copy()
            elif a == hub:
                both = _overlap(own, s)
                found.append((a, b, both, len(own) + len(s) - both))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], ["hub", "cid", "both", "all"])


def _search(percent: int):
    """Rows sorted by block pair: emits links between classes of different components, no more than join them."""

    def links(key: tuple | None, rows: list[tuple[int, int, np.ndarray, bool]]) -> list[tuple[int, int]]:
        rows = sorted(rows, key=lambda r: (len(r[2]), r[0]))
        across = key is not None and key[3]
        parent: dict[int, int] = {}

        def root(c: int) -> int:
            while parent.setdefault(c, c) != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        out = []
        for i, (cid, comp, own, side) in enumerate(rows):
            for other, its, theirs, its_side in rows[i + 1 :]:
                if 100 * len(own) < percent * len(theirs):
                    break
                if (not across or side != its_side) and root(comp) != root(its) and _similar(own, theirs, percent):
                    parent[root(its)] = root(comp)
                    out.append((cid, other))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            found = []
            for band, i, j, across, cid, comp, side, s in zip(*(batch.column(c).to_pylist() for c in range(7)), _set_of(batch, "set"), strict=True):
                if (band, i, j, across) != key:
                    found += links(key, rows)
                    key, rows = (band, i, j, across), []
                rows.append((cid, comp, s.copy(), side))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], ["src", "dst"])
        if found := links(key, rows):
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], ["src", "dst"])

    return run


LINKS = "src long, dst long"


def _stars(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """`(hub, cid, both, all)`: intersection and union of each pair's full sets. A large star is cut into chunks of members, each with a copy of the star's own set."""
    large = stored(pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("chunks")).where("chunks > 1"), "stars")
    dealt = pairs.join(key_side(large), "hub", "left").select("hub", F.pmod(F.xxhash64("cid"), F.coalesce("chunks", F.lit(1))).alias("chunk"), "cid")
    members = dealt.join(sets, "cid").select("hub", "chunk", "cid", "set")
    own = dealt.select("hub", "chunk").distinct().join(sets, F.col("hub") == F.col("cid")).select("hub", "chunk", F.lit(None).cast("long").alias("cid"), "set")
    rows = members.unionByName(own).repartition("hub", "chunk").sortWithinPartitions("hub", "chunk", "cid")
    return rows.mapInArrow(_measure, "hub long, cid long, both long, all long")


def _rest_links(members: DataFrame, stars: DataFrame, parts: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that stars have missed, from buckets that still hold several components.

    Let H be the classes of a bucket in the component of its hub, and R the others. Pairs within H don't matter. The distances
    to the hub are known, and one minus the similarity is a metric: two classes whose distances to the hub differ by more than the
    limit can't be linked. Of H, only classes within the limit of the nearest class of R are looked at, and H is left out where there is none.
    """
    limit = 1 - percent / 100 + 1e-9
    away = stars.select("hub", "cid", (1 - F.col("both") / F.col("all")).alias("away"))
    found = members.join(away, ["hub", "cid"], "left").join(parts, F.col("cid") == F.col("node"), "left")
    found = found.select("band", "hub", "cid", "n", F.coalesce("away", F.lit(0.0)).alias("away"), F.coalesce("component", "cid").alias("comp"))
    home = parts.select(F.col("node").alias("its_node"), F.col("component").alias("home"))
    found = stored(found.join(home, F.col("hub") == F.col("its_node"), "left").withColumn("side", F.col("comp") == F.coalesce("home", "hub")), "found")
    # Buckets with the same classes have the same two sums of 64-bit hashes; one of them is enough.
    prints = [F.sum(F.xxhash64("cid", F.lit(i)).cast("decimal(20,0)")).alias(f"p{i}") for i in range(2)]
    other = ~F.col("side")
    buckets = (
        found.groupBy("band")
        .agg(
            *prints,
            F.count(F.lit(1)).alias("size"),
            F.count_if(other).alias("rest"),
            F.min(F.when(other, F.col("away"))).alias("nearest"),
            F.max(F.when(F.col("side"), F.col("away"))).alias("reach"),
            F.min(F.when(other, F.col("comp"))).alias("a"),
            F.max(F.when(other, F.col("comp"))).alias("b"),
        )
        .where((F.col("rest") > 0) & ((F.col("a") < F.col("b")) | (F.col("nearest") <= F.col("reach") + limit)))
    )
    once = buckets.groupBy("p0", "p1", "size").agg(F.min("band").alias("band"), F.min("nearest").alias("nearest"))
    rows = found.join(once, "band").where(other | (F.col("away") >= F.col("nearest") - limit))
    counted = [
        F.ceil(F.greatest(F.count_if(own) / BLOCK, F.sum(F.when(own, F.col("n")).otherwise(0)) / BLOCK_SHINGLES)).cast("int").alias(name)
        for own, name in ((other, "blocks"), (F.col("side"), "home_blocks"))
    ]
    sized = stored(rows.select("band", "cid", "comp", "side").join(rows.groupBy("band").agg(*counted), "band"), "mixed")
    blocks, home_blocks = F.col("blocks"), F.col("home_blocks")
    sized = sized.withColumn("block", F.pmod(F.xxhash64("cid"), F.when(F.col("side"), home_blocks).otherwise(blocks)).cast("int"))
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    among = sized.where(other).select("*", F.explode(upto(blocks)).alias("o"))
    among = among.select("band", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), F.lit(False).alias("across"), "cid", "comp", "side")
    toward = sized.where(other).select("band", F.col("block").alias("i"), F.explode(upto(home_blocks)).alias("j"), F.lit(True).alias("across"), "cid", "comp", "side")
    back = sized.where("side").select("band", F.explode(upto(blocks)).alias("i"), F.col("block").alias("j"), F.lit(True).alias("across"), "cid", "comp", "side")
    dealt = among.unionByName(toward).unionByName(back)
    full = dealt.join(sets, "cid").select("band", "i", "j", "across", "cid", "comp", "side", "set")
    keys = ["band", "i", "j", "across"]
    return full.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_search(percent), LINKS)


def _signed(df: DataFrame, key: str, text: str, k: int, bands: int, rows: int) -> DataFrame:
    given = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("th"), F.col(f"`{text}`").alias("text"))
    return given.mapInArrow(_sign(k, bands, rows), "id long, th long, n long, s1 long, s2 long, bands array<long>")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """`(id, th, n, component)` for each input row: `th` xxhash64 of its text, `n` shingles, `component` the smallest id linked with it."""
    signed = stored(_signed(df, key, text, k, bands, rows), "signed")
    rep = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th"))
    classes = signed.where("n > 0").groupBy("n", "s1", "s2").agg(rep.alias("rep"), F.min_by("bands", F.struct("id", "th")).alias("bands"), F.count(F.lit(1)).alias("members"))
    classes = stored(classes.select(F.monotonically_increasing_id().alias("cid"), "n", "s1", "s2", F.col("rep.id").alias("low"), F.col("rep.th").alias("th"), "bands", "members"), "classes")

    banded = classes.select("cid", "n", F.explode("bands").alias("band"))
    hubs = banded.groupBy("band").agg(F.min("cid").alias("hub"), F.count(F.lit(1)).alias("size")).where("size > 1").select("band", "hub")
    members = stored(banded.join(hubs, "band").select("band", "hub", "cid", "n"), "members")
    pairs = stored(members.where("cid <> hub").select("hub", "cid").distinct(), "pairs")

    near = pairs.select("cid").union(pairs.select("hub")).distinct()
    wanted = stored(classes.join(near, "cid").select("cid", "low", F.col("th").alias("rep_th")), "near")
    texts = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("th"), F.col(f"`{text}`").alias("text"))
    held = texts.join(key_side(wanted), (F.col("th") == F.col("rep_th")) & F.col("id").eqNullSafe(F.col("low"))).select("cid", "text").dropDuplicates(["cid"])
    sets = stored(held.mapInArrow(_sets(k), "cid long, set array<long>"), "sets")

    stars = stored(_stars(pairs, sets), "stars")
    links = stars.where(100 * F.col("both") >= percent * F.col("all")).select(F.col("hub").alias("src"), F.col("cid").alias("dst"))
    parts = stored(connected_components(links, small_edges=0), "parts")
    more = stored(_rest_links(members, stars, parts, sets, percent), "links")
    if not more.isEmpty():
        parts = stored(connected_components(links.unionByName(more), small_edges=0), "parts")

    linked = stored(classes.join(parts, F.col("cid") == F.col("node")).select("cid", "component", "low"), "linked")
    lowest = stored(linked.groupBy(F.col("component").alias("comp")).agg(F.min("low").alias("lowest")), "lowest")
    named = linked.join(key_side(lowest), F.col("component") == F.col("comp")).select(F.col("cid").alias("its"), "lowest")
    # A class of one row that is linked with nothing is its own component: only the others meet their rows again.
    grouped = classes.join(named, F.col("cid") == F.col("its"), "left").where((F.col("members") > 1) | F.col("its").isNotNull())
    answer = stored(grouped.select("n", "s1", "s2", F.when(F.col("its").isNotNull(), F.col("lowest")).otherwise(F.col("low")).alias("component"), F.lit(True).alias("met")), "answer")
    with_set = signed.where("n > 0").select("id", "th", "n", "s1", "s2").join(key_side(answer), ["n", "s1", "s2"], "left")
    with_set = with_set.select("id", "th", "n", F.when(F.col("met"), F.col("component")).otherwise(F.col("id")).alias("component"))
    return with_set.unionByName(signed.where("n = 0").select("id", "th", "n", F.col("id").alias("component")))


def one_per_group(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80, k: int = 5) -> DataFrame:
    """The rows of `df` whose id is the smallest of their component; rows without shingles stay."""
    found = near_duplicates(df, key, text, k, percent)
    gone = stored(found.where(~F.col("id").eqNullSafe(F.col("component"))).select("id", "th").distinct(), "gone")
    rows = df.select(F.struct("*").alias("row"), F.col(f"`{key}`").cast("long").alias("key"), F.xxhash64(F.col(f"`{text}`")).alias("hash"))
    return rows.join(key_side(gone), (F.col("hash") == F.col("th")) & F.col("key").eqNullSafe(F.col("id")), "left_anti").select("row.*")
