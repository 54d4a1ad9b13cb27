"""Prefix trie, whitening and line dedup against plain definitions, with every odd input."""

import hashlib
import math
import random
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tabml.llm import linededup, queries, trie, whitening
from tabml.operators import ordering
from tests.llm.helpers import LOWER, odd_texts, plain, table

EMPTY_SHA = hashlib.sha256(b"").hexdigest()


# prefix trie


def _plain_trie(rows):
    """`rows`: (conv, turn, role, text)."""
    said = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            said[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [r[2:] for r in sorted(v)] for c, v in said.items()}
    built = {}
    for c, turns in own.items():
        base, h = c - int(math.fmod(c, 100)), zlib.crc32(str(c).encode()) % 6
        built[c] = (own.get(base, [])[:h]) + turns[h:]
    members = defaultdict(list)
    for c, path in sorted(built.items()):
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    saved, leaves = defaultdict(int), defaultdict(int)
    for node in sorted(members, key=len, reverse=True):
        saved[node] += (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        leaves[node] += not children[node]
        if node:
            saved[node[:-1]] += saved[node]
            leaves[node[:-1]] += leaves[node]
    out = []
    for node, held in members.items():
        ends = ",".join(str(c) for c in held if len(built[c]) == len(node))
        out.append((held[0], len(node), members[node[:-1]][0] if node else None, len(held), len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return plain(out)


def _talks(spark, rows):
    full = [(*r, 1, 2, "x", 3, 4) for r in rows]
    return spark.createDataFrame(full, "conv_id long, turn long, role string, text string, pos long, depth int, h1 string, block long, k1 int")


def _found_trie(spark, rows):
    return plain(trie.prefix_trie(trie.with_shared_starts(trie.numbered_turns(_talks(spark, rows)))).collect())


def _odd_talks():
    rng = random.Random(5)
    rows = []
    for c in [*range(0, 40), *range(100, 130), 205, 207, -3, -100, -104, None]:
        for t in range(rng.choice([1, 2, 3, 9, 17, 33])):
            rows.append((c, t, rng.choice(["user", "bot", None]), rng.choice(["hi", "Hi", "ünïcode 😀", "", None])))
    rows += [(300, None, "user", "first"), (300, None, "bot", "first"), (300, 1, None, None), (300, 1, None, None), (301, 5, "user", "late" * 20_000)]
    rows += [(c, t, "user", f"same {t}") for c in range(400, 460) for t in range(7)]  # one conversation sixty times
    rows += [(500, t, "user", str(t % 3)) for t in range(300)]  # a long one
    rows += [(501, t, "user", str(t % 3)) for t in range(299)]
    return rows


@pytest.mark.parametrize("small", [200_000, 1])
def test_trie_is_the_plain_one(spark, monkeypatch, small):
    monkeypatch.setattr(ordering, "SMALL_ROWS", small)  # 1: very long conversations are cut into ranges
    rows = _odd_talks()
    assert _found_trie(spark, rows) == _plain_trie(rows)


def test_trie_of_paths_that_hang_on_paths(spark):
    # conversation 100 * i shares i turns with all before it: a chain of paths, each hung on the one before
    rows = [(100 * i, t, "user", f"{min(i, t)}") for i in range(12, 0, -1) for t in range(20)]
    assert _found_trie(spark, rows) == _plain_trie(rows)


def test_trie_pieces_of_ends_are_one_digest(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 10)
    rows = [(c, 0, "user", "same") for c in range(100)]
    assert _found_trie(spark, rows) == _plain_trie(rows)


def test_trie_of_nothing(spark):
    assert _found_trie(spark, []) == []
    assert _found_trie(spark, [(None, 1, "user", "x")]) == []
    one = _found_trie(spark, [(200, None, None, None)])  # 200 takes its own first turn as its start
    assert [r[:5] for r in one] == [(200, 0, None, 1, 1), (200, 1, 200, 1, 0)]


# whitening


def _vectors(spark, rows):
    return spark.createDataFrame([(*r, 7, 8.0, [1]) for r in rows], "vec_id long, embedding array<double>, component int, whitened double, x array<int>")


def _checked(found, rows, dimensions, tolerance=1e-9):
    """`rows`: usable (id, vector)."""
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows])
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    centred = fit - total / n
    cov = centred.T @ centred / n
    values, base = np.linalg.eigh(cov)
    values, base = values[::-1], base[:, ::-1]
    by_id = defaultdict(dict)
    for r in found:
        assert r["n"] == n
        assert abs(r["explained"] - values[r["component"] - 1] / np.trace(cov)) <= 1e-9
        assert r["identity_error"] <= 1e-6
        by_id[r["row"]["vec_id"]].setdefault(r["component"], []).append((r["deviation"], r["whitened"]))
    size = min(16, int((values > 1e-9 * values[0]).sum()), dimensions)
    assert sum(len(v) for c in by_id.values() for v in c.values()) == size * len(rows)
    signs = {}
    for (i, _), row in zip(rows, x, strict=True):
        for k in range(size):
            want = (row - total / n) @ base[:, k] / np.sqrt(values[k])
            deviation, got = by_id[i][k + 1][0]
            assert deviation == sum((n * int(a) - int(t)) ** 2 for a, t in zip(row, total))
            if abs(want) > 1e-6:
                signs.setdefault(k, np.sign(want) * np.sign(got))
                assert abs(got * signs[k] - want) < tolerance * max(1, abs(want))


def test_whitening_is_the_plain_one(spark):
    rng = np.random.default_rng(3)
    mixing = rng.normal(size=(20, 20)) * np.linspace(0.2, 3, 20)
    good = [(i, (rng.normal(size=20) @ mixing).tolist()) for i in range(400)]
    good += [(1000 + i, good[i % 7][1]) for i in range(150)]  # repeated vectors count once
    bad = [(None, None), (1, None), (2, [None] * 20), (3, [float("nan")] * 20), (4, [float("inf")] + [0.0] * 19), (5, [0.5] * 3), (6, []), (7, [1e300] * 20)]
    found = whitening.whitened(_vectors(spark, good + bad)).collect()
    _checked(found, good, 20)
    assert found[0]["row"].asDict()["whitened"] == 8.0


def test_whitening_of_the_table(spark):
    source = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in source.collect()]
    _checked(whitening.whitened(source).collect(), rows, 64, 1e-7)
    found = queries.QUERIES["op12_whitening"](spark, "/root/testdata/sf0.001")
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and found.count() == 16 * len(rows)


def test_whitening_without_spread(spark):
    assert whitening.whitened(_vectors(spark, [])).count() == 0
    assert whitening.whitened(_vectors(spark, [(1, [0.5, 0.5]), (2, [0.5, 0.5])])).count() == 0
    flat = [(i, [float(i), 2.0 * i, 1.0]) for i in range(9)]  # rank one: a single component
    found = whitening.whitened(_vectors(spark, flat)).collect()
    assert {r["component"] for r in found} == {1} and len(found) == 9


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(1, 100, 64),
        np.concatenate([np.full(8, 50) + np.arange(8) * 1e-9, np.full(8, 49.9999999) + np.arange(8) * 1e-7, np.linspace(1, 10, 48)]),
        np.concatenate([np.full(20, 50.0), np.linspace(1, 10, 44)]),
        np.concatenate([np.zeros(20), np.linspace(1e-6, 10, 44)]),
    ],
)
def test_eigenvectors_to_double_precision(values):
    rng = np.random.default_rng(0)
    q, _ = np.linalg.qr(rng.normal(size=(64, 64)))
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    found, x = whitening.refined_eigen(a)
    assert np.abs(found - np.linalg.eigvalsh(a)[::-1]).max() < 1e-12 * values.max()
    assert np.abs(a @ x - x * found).max() < 1e-12 * values.max() and np.abs(x.T @ x - np.eye(64)).max() < 1e-14
    gaps = np.abs(np.diff(np.sort(values)))
    if gaps.min() > 1e-3:  # far better than the float32 start
        start = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1]
        exact = np.linalg.eigh(a)[1][:, ::-1]
        off = lambda y: np.abs(np.abs((exact * y).sum(axis=0)) - 1).max()
        assert off(x) < 1e-13 and off(x) <= off(start)


def test_deviations_are_exact_or_missing():
    x = np.array([[3, 5], [1 << 40, 0]])
    assert whitening.deviations(x, np.array([4, 4]), 2) == [40, None]
    assert whitening.deviations(x[:0], np.array([4, 4]), 2) == []


# lines


def _plain_lines(rows, shortest=10, at_least=2):
    """`rows`: (id, text)."""
    held = defaultdict(set)
    split = [(i, (t or "").split("\n")) for i, t in rows]
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    for i, lines in split:
        for line in lines:
            held[key(line)].add(i)
    out = []
    for i, lines in split:
        kept = []
        for line in lines:
            k = key(line)
            ids = held[k]
            keeper = min((j for j in ids if j is not None), default=None)
            if not (len(k) >= shortest and len(ids) >= at_least and i != keeper):
                kept.append(line)
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return plain(out)


def _line_rows():
    rng = random.Random(9)
    shared = ["A line that many documents hold", "  a LINE that many documents hold\t", "ünïcode öf tén", "short", "ten chars!", "nine char", "", " \t "]
    rows = [(r[0], r[1]) for r in odd_texts()]
    rows += [(1000 + i, "\n".join(rng.choice([*shared, f"own line number {i}"]) for _ in range(rng.randrange(1, 9)))) for i in range(200)]
    rows += [(2000, "\n".join(shared * 500)), (None, shared[0]), (None, "only without an id\nonly without an id"), (None, "only without an id"), (3000, "\n"), (3001, "trailing newline here\n"), (3002, "Trailing Newline here")]
    return rows


def _line_table(spark, rows):
    return spark.createDataFrame([(*r, 1, "a", 2, 3, 4, [5]) for r in rows], "doc_id long, text string, row int, id string, pos int, k1 int, t1 int, dropped array<int>")


@pytest.mark.parametrize("at_least", [2, 3])
def test_lines_dropped_are_the_plain_ones(spark, at_least):
    rows = _line_rows()
    found = linededup.deduplicated(_line_table(spark, rows), at_least=at_least)
    assert plain(found.select("row.doc_id", "n_lines", "n_dropped", "kept_text").collect()) == _plain_lines(rows, at_least=at_least)
    assert found.first()["row"]["dropped"] == [5]


def test_lines_by_shuffle_alike(spark, monkeypatch):
    rows = _line_rows()
    for module in (linededup, __import__("tabml.llm.joins", fromlist=["x"])):
        monkeypatch.setattr(module, "MOST_KEYS", -1)
    monkeypatch.setattr(linededup, "PIECE_BYTES", 50)
    found = linededup.deduplicated(_line_table(spark, rows), carry=["doc_id"])
    assert plain(found.select("row.doc_id", "n_lines", "n_dropped", "kept_text").collect()) == _plain_lines(rows)


def test_lines_of_nothing(spark):
    assert linededup.deduplicated(_line_table(spark, [])).count() == 0
    found = linededup.deduplicated(_line_table(spark, [(1, None), (2, "")]))
    assert plain(found.select("row.doc_id", "n_lines", "n_dropped", "kept_text").collect()) == [(1, 1, 0, ""), (2, 1, 0, "")]
    odd = linededup.deduplicated(table(spark))
    assert odd.count() == len(odd_texts())


def test_names_that_are_not_numbers(spark):
    rows = [("b", "the very same line"), ("a", "The very same line "), (None, "the very same line")]
    found = linededup.deduplicated(spark.createDataFrame(rows, "doc_id string, text string"))
    assert plain(found.select("row.doc_id", "n_lines", "n_dropped", "kept_text").collect()) == _plain_lines(rows)


def test_line_hashes_take_little_memory():
    texts = pa.array(["\n".join(f"line {i} of text {t}, long enough" for i in range(200)) for t in range(400)])
    ids = pa.array(range(400))
    batch = pa.RecordBatch.from_arrays([ids, ids, ids, texts], ["id", "t1", "t2", "text"])
    assert texts.nbytes > 2_000_000
    linededup._powers.clear()
    tracemalloc.start()
    found = sum(b.num_rows for b in linededup._hashed(10)(iter([batch])))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == 80_000
    assert most < 30_000_000  # 70 MB with pieces of a megabyte
