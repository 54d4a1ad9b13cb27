"""Near-duplicates, decontamination and mixing: odd inputs and brute force."""

import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tabml.llm import decontam, mixing, neardup, tokens
from tests.llm.helpers import ALNUM, odd_texts, plain, prose, table, words


def _shingles(text, k=5):
    w = words(text)
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def _components(rows, percent):
    sets = [_shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            parent[root(j)] = root(i)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return [(r[0], len(sets[i]), least.get(root(i)) if sets[i] else r[0]) for i, r in enumerate(rows)]


def _families():
    """Groups of edited copies around each other, at similarities on both sides of the limit, and many copies of one text."""
    rng, rows = random.Random(5), []
    for family in range(12):
        base = prose(1000 + family, 120, 3000).split(" ")
        for copy in range(8):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 4, 6, 10])):
                text[rng.randrange(len(text))] = f"e{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(text), "en", "a"))
    return rows + [(10_000 + i, rows[0][1].upper(), "en", "a") for i in range(200)]


@pytest.mark.parametrize("percent", [80, 85])
def test_components_match_brute_force(spark, percent):
    rows = odd_texts() + _families()
    found = neardup.near_duplicates(table(spark, rows), percent=percent).select("id", "n", "component").collect()
    assert plain(found) == plain(_components(rows, percent))


def test_links_that_stars_miss_are_found(spark):
    base = [f"b{i}" for i in range(200)]
    rows = []
    for i in range(60):  # each is near the base, which has the largest id; hardly any is near another
        text = list(base)
        for j in range(3):
            text[(i * 37 + j * 61) % 195 + 2] = f"x{i}-{j}"
        rows.append((i, " ".join(text), "en", "a"))
    rows.append((99, " ".join(base), "en", "a"))
    found = neardup.near_duplicates(table(spark, rows), percent=85).select("id", "n", "component").collect()
    assert plain(found) == plain(_components(rows, 85))


def test_search_of_mixed_buckets_joins_components(spark):
    rows = _families()[:96]
    sets = {i: np.sort(np.array([hash(s) & (2**63 - 1) for s in _shingles(r[1])], np.uint64)) for i, r in enumerate(rows)}
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1] * 96), pa.array([0] * 96), pa.array([0] * 96), pa.array([False] * 96), pa.array(range(96)), pa.array(range(96)), pa.array([False] * 96), pa.array([s.view(np.int64) for s in sets.values()], pa.list_(pa.int64()))],
        ["band", "i", "j", "across", "cid", "comp", "side", "set"],
    )
    links = [x for b in neardup._search(85)(iter([batch])) for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
    parent = list(range(96))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        assert root(a) != root(b)  # never more links than join components
        parent[root(a)] = root(b)
    want = _components(rows, 85)
    assert all((root(i) == root(j)) == (want[i][2] == want[j][2]) for i, j in itertools.combinations(range(96), 2))


def test_one_document_of_each_group_stays(spark):
    docs = table(spark)
    kept = neardup.one_per_group(docs, percent=80)
    assert kept.schema == docs.schema
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids[1] == 1 and ids[2] == 0 and ids[3] == 0 and ids[4] == 1 and ids[None] == 2
    assert neardup.one_per_group(docs.limit(0)).count() == 0
    assert neardup.near_duplicates(docs.limit(0)).count() == 0


def test_densified_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    orders = neardup._orders(252)
    for n in (3, 30, 3000):
        same = []
        for _ in range(60):
            both = rng.integers(0, 2**63, n, dtype=np.uint64)
            a, b = np.sort(both[: n - n // 3]), np.sort(np.concatenate([both[: n - 2 * (n // 3)], both[n - n // 3 :]]))
            hashes, bounds = np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])
            x, y = neardup.signatures(hashes, bounds, 252, 1, orders)
            same.append((x == y).mean())
        true = (n - 2 * (n // 3)) / n
        assert abs(np.mean(same) - true) < 0.06


def _contamination(docs, items):
    window = defaultdict(set)
    for item, text in items:
        w = words(text, ALNUM)
        for i in range(max(1, len(w) - 12) if w else 0):
            window[tuple(w[i : i + 13])].add(str(item))
    out = []
    for r in docs:
        w, hit, found = words(r[1], ALNUM), set(), set()
        for n in {len(k) for k in window}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in window:
                    hit.update(range(i, i + n))
                    found |= window[tuple(w[i : i + n])]
        out.append((r[0], len(w), len(hit), sorted(found)))
    return out


def _benchmark(spark, items):
    return spark.createDataFrame([(*i, 1, 2) for i in items], "item_id long, text string, print int, value int")


def test_contamination_matches_brute_force(spark):
    rows = odd_texts()
    long = words(rows[7][1], ALNUM)
    items = [(0, " ".join(long[500:513])), (1, " ".join(long[505:560])), (2, "Zwei, Wörter!"), (3, "line"), (4, None), (5, ""), (6, "... !!!"), (7, "repeated row " * 7), (8, "repeated row " * 7), (None, "same id other text")]
    items += [(10 + i, " ".join(words(prose(100 + i, 60), ALNUM)[5 : 17 + i % 5])) for i in range(30)]
    rows = rows + [(500, " ".join([*long[:40], *long[490:600], *long[:40]]), "en", "a")]
    found = decontam.contamination(table(spark, rows), _benchmark(spark, items))
    got = [(r["id"], r["n_words"], r["n_hit"], r["items"]) for r in found.collect() for _ in range(r["copies"])]
    want = _contamination(rows, [i for i in items if i[0] is not None])
    named = [(a, b, c, [x for x in d if x is not None]) for a, b, c, d in got]
    assert [x[:2] for x in plain(named)] == [x[:2] for x in plain(want)]
    assert {x[0]: (x[2], x[3]) for x in named if x[0] not in (None, 8)} == {x[0]: (x[2], x[3]) for x in want if x[0] not in (None, 8)}


def test_decontaminated_keeps_clean_rows_and_columns(spark):
    docs = table(spark)
    kept = decontam.decontaminated(docs, _benchmark(spark, [(1, prose(1, 300))]))
    assert kept.schema == docs.schema
    gone = Counter(r[0] for r in odd_texts()) - Counter(r["doc_id"] for r in kept.collect())
    assert set(gone) == {1, 2, 3}
    assert decontam.decontaminated(docs, _benchmark(spark, []).limit(0)).count() == docs.count()
    assert decontam.decontaminated(docs.limit(0), _benchmark(spark, [(1, "a b c")])).count() == 0


def test_every_shared_window_chooses_the_same_fingerprint():
    rng = random.Random(3)
    for _ in range(50):
        shared = [rng.choice("abcdefgh") for _ in range(13)]
        texts = [" ".join([*(rng.choice("abcdefgh") for _ in range(rng.randrange(30))), *shared, *(rng.choice("abcdefgh") for _ in range(rng.randrange(30)))]) for _ in range(2)]
        prints = []
        for t in texts:
            w = tokens.words_of(pa.array([t]), tokens.ALNUM)
            first, value, at = decontam.winnowed(w, 13, 5)
            want = tokens.windows(tokens.words_of(pa.array([" ".join(shared)]), tokens.ALNUM).hash, 13)[0]
            prints.append({int(tokens.windows(w.hash, 5)[at[i]]) for i in np.flatnonzero(value == want)})
        assert prints[0] == prints[1] and len(prints[0]) == 1


def test_tokens_match_regular_expressions():
    texts = [r[1] for r in odd_texts()] + ["ÀB\u00a0c", "x\u2003y", "A\x85B", "a" * 50]
    column = pa.array(texts, pa.string())
    for inside, pattern in ((tokens.SPACED, None), (tokens.ALNUM, ALNUM)):
        for part in (column, column.slice(3, 20), column.cast(pa.large_string())):
            w = tokens.words_of(part, inside)
            got = [[w.data[w.first[i] : w.last[i]].tobytes().decode() for i in range(w.bounds[t], w.bounds[t + 1])] for t in range(len(part))]
            assert got == [words(t, pattern) if pattern else words(t) for t in part.to_pylist()]
            by = defaultdict(set)
            for i, h in enumerate(w.hash):
                by[w.data[w.first[i] : w.last[i]].tobytes()].add(int(h))
            assert all(len(h) == 1 for h in by.values()) and len({h for x in by.values() for h in x}) == len(by)


def test_targets_share_by_weight_and_stop_at_three_times_the_size():
    assert mixing.targets({"a": 100, "b": 100}, {"a": 5, "b": 5}) == {"a": 100, "b": 100}
    got = mixing.targets({"a": 10, "b": 500, "c": 500}, {"a": 5, "b": 2, "c": 1})
    assert got["a"] == 30 and got["b"] == pytest.approx(980 * 2 / 3) and got["c"] == pytest.approx(980 / 3)
    assert mixing.targets({}, {}) == {}


def test_flow_is_feasible_and_uses_all_once_before_any_twice():
    plan = mixing.flow({("a",): 100, ("a", "b"): 100, ("b",): 10}, {"a": 150, "b": 120}, 3)
    assert sum(v.get("a", 0) for v in plan.values()) == 150 and sum(v.get("b", 0) for v in plan.values()) == 120
    used = {p: sum(v.values()) for p, v in plan.items()}
    assert used[("a",)] >= 100 and used[("a", "b")] >= 100 and used[("b",)] >= 10
    cost = sum(t * t * min(100 if p != ("b",) else 10, max(0, n - t * (100 if p != ("b",) else 10))) for p, n in used.items() for t in range(3))
    assert cost == 60  # 210 words once, 60 more at a cost of 1 each
    assert mixing.flow({("a",): 10}, {"a": 1000}, 3) == {("a",): {"a": 30}}


def _mix(spark, rows, key=("doc_id", "text")):
    from pyspark.sql import functions as F

    weights = lambda sources: {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    return mixing.mixed(table(spark, rows), F.array("source"), weights, mixing.word_count(F.col("text")), list(key))


def test_mix_comes_near_its_targets(spark):
    rows = [(i, prose(i, 5 + i % 30), "en", ["a", "b", "c", None][i % 4] if i % 3 else "a") for i in range(2000)]
    mix = _mix(spark, rows)
    found = mix.rows.select("row.source", "size", "source_size", "target", "taken").collect()
    got, size = Counter(), Counter()
    for r in found:
        assert r["taken"] % r["size"] == 0 and r["taken"] <= 3 * r["size"]
        got[r["source"]] += r["taken"]
        size[r["source"]] += r["size"]
    for r in found:
        assert r["source_size"] == size[r["source"]] and abs(got[r["source"]] - r["target"]) <= 40
    again = _mix(spark, rows).rows.select("row.doc_id", "taken").collect()
    assert plain(again) == plain(mix.rows.select("row.doc_id", "taken").collect())


def test_mix_of_odd_rows(spark):
    found = _mix(spark, odd_texts()).rows
    assert found.count() == len(odd_texts())
    assert {r["taken"] for r in found.where("size = 0").collect()} == {0}
    assert _mix(spark, []).rows.count() == 0
    assert found.select("row.*").schema == table(spark).schema
