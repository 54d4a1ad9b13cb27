"""Quality rules, sharding, quotations: odd inputs and brute force."""

import itertools
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tabml.llm import quality, quotes, sharding
from tabml.llm.prefix import PrefixSums
from tests.llm.helpers import SPACED, odd_texts, plain, prose, table


def _measures(text):
    ws, t = SPACED.findall(text or ""), text or ""
    windows = Counter(tuple(ws[i : i + 3]) for i in range(len(ws) - 2))
    covered = {i + k for i in range(len(ws) - 2) if windows[tuple(ws[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if SPACED.search(x)]
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def test_quality_measures_match_their_definition(spark):
    found = quality.judged(table(spark)).select("row.doc_id", "q.n_words", "q.word_chars", "q.n_symbols", "q.lines.dup", "q.n_repeat_words", "base_failed").collect()
    want = []
    for r in odd_texts():
        m = _measures(r[1])
        want.append((r[0], *m, m[0] < 50 or 100 * m[4] > 50 * m[0]))
    assert plain(found) == plain(want)


def test_quality_keeps_all_columns_and_empty_tables(spark):
    docs = table(spark)
    assert quality.judged(docs).select("row.*").schema == docs.schema
    assert quality.judged(docs.limit(0)).count() == 0


def test_bad_host_is_blocked_and_strict_host_drops_what_fails(spark):
    good, noisy = [prose(i, 80) for i in range(40)], [prose(i, 60) + " #" * 20 for i in range(40)]
    rows = [(i, t, "en", "good") for i, t in enumerate(good)]
    rows += [(100 + i, "too short", "en", "bad") for i in range(60)] + [(199, prose(9, 80), "en", "bad")]
    rows += [(200 + i, t, "en", "noisy") for i, t in enumerate(noisy)] + [(299, prose(8, 80), "en", "noisy")]
    rows += [(300, noisy[0], "en", "good"), (301, "too short", "en", "tiny"), (302, prose(7, 80), "en", "tiny")]
    kept = {r["doc_id"] for r in quality.judged(table(spark, rows)).where("kept").select("row.doc_id").collect()}
    assert kept == {*range(40), 299, 300, 302}


def test_clear_failures_go_everywhere_slight_ones_on_worse_hosts(spark):
    """Planted on the whole table: symbols and repeated lines, slight and clear, on a usual host and on one that is worse than usual."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source")
    lines = [prose(i, 30).replace("\n", " ") for i in range(6)]
    slight, clear = prose(1, 100) + " #" * 16, prose(2, 100) + " #" * 60
    mixed = "\nok\n".join([*lines[:4], ""]) + " #" * 32
    host = docs.first()["source"]
    planted = [(10**6, slight, host), (10**6 + 1, clear, host), (10**6 + 2, prose(3, 100), host), (10**6 + 3, mixed, host)]
    planted += [(10**6 + 10 + i, prose(50 + i, 100) + " #" * 16, "noisy") for i in range(60)] + [(10**6 + 90 + i, prose(i, 100), "noisy") for i in range(3)]
    rows = [tuple(r) for r in docs.collect()] + [(i, t, "en", h) for i, t, h in planted]
    found = {r["doc_id"]: r for r in quality.judged(table(spark, rows)).select("row.doc_id", "base_failed", "kept").collect()}
    assert not any(found[i]["base_failed"] for i, _, _ in planted)
    assert [found[10**6 + i]["kept"] for i in range(4)] == [True, False, True, False]
    assert not any(found[10**6 + 10 + i]["kept"] for i in range(60)) and all(found[10**6 + 90 + i]["kept"] for i in range(3))
    beyond = [r for i, r in found.items() if i < 10**6 and not r["kept"] and not r["base_failed"]]
    assert beyond  # junk of the table itself goes too
    few = quality.judged(table(spark, rows), most_keys=0).select("row.doc_id", "base_failed", "kept")
    assert plain(few.collect()) == plain(found.values())


def test_prior_without_spread_outweighs_hosts():
    assert quality.prior(0, 0, 0.0, 0, 0.0) == (0.0, 1e6)
    assert quality.prior(3, 30, 300.0, 0, 0.0) == (0.0, 1e6)
    mean, weight = quality.prior(2, 200, 20_000.0, 100, 100.0)
    assert mean == 0.5 and weight < 1


def _least_capacity(sizes, shards):
    """By trying each sum of consecutive groups."""
    def fits(cap):
        n, at = 1, 0
        for s in sizes:
            if s > cap:
                return False
            n, at = (n + 1, s) if at + s > cap else (n, at + s)
        return n <= shards
    sums = sorted({sum(sizes[i:j]) for i, j in itertools.combinations(range(len(sizes) + 1), 2)})
    return next(c for c in sums if fits(c))


def test_capacity_is_the_least_and_cuts_respect_it(spark):
    for seed, shards in [(1, 3), (2, 7), (3, 24)]:
        sizes = [1 + (i * 7919 * seed) % 97 for i in range(60)]
        rows = spark.createDataFrame([(i * 10**16 + 5, s) for i, s in enumerate(sizes)], "q long, size long")
        capacity, cuts = sharding.cuts_for(PrefixSums(rows, 58, step=2), shards)
        assert capacity == _least_capacity(sizes, shards)
        marks = [c for c in cuts if c is not None]
        load = Counter(sum(c <= i * 10**16 + 5 for c in marks) for i in range(60) for _ in range(sizes[i]))
        assert max(load.values()) <= capacity and len(marks) == len(cuts) and marks == sorted(marks)
        assert len(load) == shards  # no shard is left empty


def test_sharding_keeps_groups_and_numbers_slots(spark):
    docs = table(spark)
    found = sharding.sharded(docs, 5).select("row.doc_id", "row.text", "size", "shard", "slot").collect()
    assert plain((r["doc_id"], r["text"]) for r in found) == plain((r[0], r[1]) for r in odd_texts())
    of, slots = defaultdict(set), defaultdict(list)
    for r in found:
        assert r["size"] == len((r["text"] or "").encode()) + 8
        of[r["text"]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
    assert all(len(s) == 1 for s in of.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.sharded(docs, 5).select("row.*").schema == docs.schema
    assert sharding.sharded(docs.limit(0), 5).count() == 0


def test_one_shard_and_more_shards_than_groups(spark):
    rows = [(i, f"text {i % 3}", "en", "a") for i in range(30)]
    assert {r["shard"] for r in sharding.sharded(table(spark, rows), 1).collect()} == {0}
    assert len({r["shard"] for r in sharding.sharded(table(spark, rows), 10).collect()}) == 3


def _talk(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, origin string")


def test_nested_quotations_are_linked_and_removed(spark):
    rows = [
        (1, 0, "a", "First point.\nSecond  point."),
        (1, 1, "b", "a wrote:\n> first POINT.\nI agree."),
        (1, 2, "c", "Unrelated."),
        (1, 3, "a", "> > First point.\n> I agree.\nThanks"),
        (1, 4, "c", ">Unrelated.\n> not said by anyone"),
        (1, 5, "c", "> Second\n> point.\n>  \n> > unknown\n> First point.\n> Second point.\n> not said\nok"),
        (1, 6, "b", "> first\n> point. second\n> point.\nrewrapped"),
        (2, 0, "a", "> First point."),
        (None, 0, "a", "null conversation"),
        (None, 1, "b", "> null conversation\nyes"),
        (3, None, "a", "> no turn"),
        (3, 0, None, None),
        (3, 0, None, None),
        (4, 0, "a", "x" * 100_000),
        (4, 1, "a", "> " + "x" * 100_000),
    ]
    got = {(r["conv_id"], r["turn"]): r for r in quotes.threaded(_talk(spark, rows)).collect()}
    assert len(got) == len(rows) - 1
    pick = lambda k: tuple(got[k][c] for c in ("text", "n_passages", "n_quoted", "n_linked", "reply_to", "thread"))
    assert pick((1, 0)) == ("First point.\nSecond  point.", 0, 0, 0, None, 0)
    assert pick((1, 1)) == ("I agree.", 1, 1, 1, 0, 0)
    assert pick((1, 2)) == ("Unrelated.", 0, 0, 0, None, 2)
    assert pick((1, 3)) == ("Thanks", 2, 2, 2, 1, 0)
    assert pick((1, 4)) == ("", 1, 2, 1, 2, 2)
    assert pick((1, 5)) == ("ok", 3, 7, 5, 0, 0)
    assert pick((1, 6)) == ("rewrapped", 1, 3, 3, 0, 0)
    assert pick((2, 0)) == ("", 1, 1, 0, None, 0)
    assert pick((None, 1)) == ("yes", 1, 1, 1, 0, 0)
    assert pick((3, None)) == ("", 1, 1, 0, None, None)
    assert pick((3, 0)) == ("", 0, 0, 0, None, 0)
    assert pick((4, 1))[4] == 0
    assert quotes.threaded(_talk(spark, rows).limit(0)).count() == 0


def test_long_reply_chains_lead_to_their_first_message(spark):
    rows = [(1, 0, "a", "line 0")] + [(1, i, "a", f"> line {i - 1}\nline {i}") for i in range(1, 40)]
    assert {r["thread"] for r in quotes.threaded(_talk(spark, rows)).collect()} == {0}
    assert quotes.threaded(_talk(spark, rows)).agg(F.sum("n_linked")).first()[0] == 39


def test_parts_of_messages_and_parts_wrapped_anew_are_linked(spark):
    rows = [
        (1, 0, "a", "We met on Monday. The plan was agreed by all of us, and nobody objected to it. Who writes it up?"),
        (1, 1, "b", "I would.\nGive me the notes\nthat you took on Monday,\nplease."),
        (1, 2, "c", "> The plan was agreed by all of us, and nobody objected to it.\nNot me."),
        (1, 3, "a", "> > the plan was agreed\n> Give me the notes that you took\n> on Monday,\nHere."),
        (1, 4, "b", "> Who writes\n> it up?\nMe."),
        (1, 5, "c", "> nobody objected to it. [...]\n> that you took on Monday, please.\nok"),
        (1, 6, "c", "> by all of us, nobody objected to it.\nnot in a row"),
        (2, 0, "c", "> The plan was agreed by all of us\nanother conversation"),
        (None, 0, "a", "one two three four"),
        (None, 1, "b", "> two three\nyes"),
    ]
    got = {(r["conv_id"], r["turn"]): (r["n_linked"], r["reply_to"], r["thread"]) for r in quotes.threaded(_talk(spark, rows)).collect()}
    assert got[1, 2] == (1, 0, 0)
    assert got[1, 3] == (3, 1, 1)
    assert got[1, 4] == (2, 0, 0)
    assert got[1, 5] == (1, 1, 1)
    assert got[1, 6] == (0, None, 6)
    assert got[2, 0] == (0, None, 0)
    assert got[None, 1] == (1, 0, 0)


def test_every_earlier_message_may_hold_a_part(spark):
    rows = [
        (1, 0, "a", "Please see the plan today"),
        (1, 1, "b", "My plan was rejected"),
        (1, 2, "c", "I heard the plan was agreed yesterday"),
        (1, 3, "a", "> the plan was\nso?"),
        (1, 4, "b", "> the plan was rejected\nnot said in a row by anyone"),
    ]
    got = {r["turn"]: (r["n_linked"], r["reply_to"]) for r in quotes.threaded(_talk(spark, rows)).collect()}
    assert got[3] == (1, 2) and got[4] == (0, None)


def test_all_planted_parts_are_found(spark):
    """Parts of every length, wrapped anew, of messages from few words: each is linked to the first message that holds it, by brute force."""
    rng = random.Random(5)
    rows, want = [], {}
    for conv in range(4):
        said = []
        for turn in range(40):
            own = [f"v{rng.randrange(8)}" for _ in range(rng.randrange(5, 60))]
            quote = []
            if turn:
                source = rng.choice(said)
                n = rng.randrange(1, len(source))
                at = rng.randrange(len(source) - n + 1)
                quote = source[at : at + n]
                hold = f" {' '.join(quote)} "
                want[conv, turn] = next(t for t, s in enumerate(said) if hold in f" {' '.join(s)} ")
            cut = rng.randrange(len(quote) + 1)
            lines = [" ".join(q) for q in (quote[:cut], quote[cut:]) if q]
            rows.append((conv, turn, "a", "\n".join([*(f"> {x}" for x in lines), " ".join(own)])))
            said.append(own)
    got = {(r["conv_id"], r["turn"]): (r["n_quoted"], r["n_linked"], r["reply_to"]) for r in quotes.threaded(_talk(spark, rows)).collect()}
    assert all(got[k][0] == got[k][1] > 0 for k in want)
    # A passage whose lines are whole lines of messages is linked line by line first; that needs equal lines, which these never are.
    assert {k: got[k][2] for k in want} == want
