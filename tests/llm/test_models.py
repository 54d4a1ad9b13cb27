"""Language, URL, toxicity and language models: held-out accuracy, plain definitions, odd inputs."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabml.llm import language, lm, toxicity, urls
from tests.llm.helpers import odd_texts, plain, table, words

DATA = "/root/testdata/sf0.01"


def _grams(text):
    bare = "".join(c.lower()[0] if c.isalpha() else " " for c in text or "")
    bare = " " + " ".join(bare.split()) + " "
    return Counter(bare[i : i + 3] for i in range(len(bare) - 2) if bare[i : i + 3].strip())


def test_gram_counts_match_their_definition():
    texts = ["Ab, c", None, "", "...", "ÄÖ ü\n\nx", "a", " lead and trail  ", "İx", "日本語 テスト", "x" * 30]
    counts, grams = language.gram_counts(texts, 3)
    for row, text in zip(counts, texts, strict=True):
        assert {"".join(map(chr, g)): int(c) for g, c in zip(grams, row, strict=True) if c} == dict(_grams(text))


def test_bundles_bind_rolled_letters():
    counts, grams = language.gram_counts(["abc abd", "b"], 3)
    v = lambda c, j: np.roll(language.letter_vector(ord(c), 64), j)
    want = sum(n * v(g[0], 0) * v(g[1], 1) * v(g[2], 2) for g, n in _grams("abc abd").items())
    assert np.array_equal(language.Encoder(64, 3).bundles(counts, grams)[0], want)


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    held = language.held_out(F.col("doc_id"), 5, 0)
    names, protos = language.prototypes(docs.where(~held))
    found = language.predicted(docs, names, protos).where(language.held_out(F.col("row.doc_id"), 5, 0)).select("row.lang", "lang_pred", "score").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) >= 0.97 * len(found)
    assert all(0 <= r["score"] <= 1 for r in found)
    assert {zlib.crc32(str(i).encode()) % 5 == 0 for i in [r["doc_id"] for r in docs.where(held).select("doc_id").limit(50).collect()]} == {True}


def test_language_of_odd_rows(spark):
    docs = table(spark)
    names, protos = language.prototypes(docs)
    assert names == ["de", "en", "fr"]
    found = language.predicted(docs, names, protos)
    got = {(r["doc_id"], r["text"]): (r["lang_pred"], r["score"]) for r in found.select("row.*", "lang_pred", F.col("score").alias("s")).select("doc_id", "text", "lang_pred", F.col("s").alias("score")).collect()}
    assert all(got[k] == ("und", 0.0) for k in [(4, None), (5, ""), (6, " \t\n "), (12, "!!! ... ---"), (None, None)])
    assert all(v[0] in names for k, v in got.items() if any(c.isalpha() for c in k[1] or ""))
    none = language.prototypes(docs.limit(0))
    assert {r["lang_pred"] for r in language.predicted(docs, *none).collect()} == {"und"}
    assert language.predicted(docs.limit(0), names, protos).count() == 0


def _naive_log(examples, url, order):
    """Witten-Bell by the definition, on one URL."""
    seq = lambda u: [urls.FIRST] * order + list(u.encode()) + [urls.END]
    total, kinds, own = Counter(), Counter(), Counter()
    for u in examples:
        s = seq(u)
        for i in range(order, len(s)):
            for k in range(order + 1):
                c = tuple(s[i - k : i])
                total[c] += 1
                kinds[c] += own[c, s[i]] == 0
                own[c, s[i]] += 1
    s, out = seq(url), 0.0
    for i in range(order, len(s)):
        p = 1 / 257
        for k in range(order + 1):
            c = tuple(s[i - k : i])
            if total[c]:
                p = (own[c, s[i]] + kinds[c] * p) / (total[c] + kinds[c])
        out += math.log(p)
    return out / (len(s) - order)


def test_markov_model_matches_its_definition():
    examples = ["http://a.com/x", "http://b.com/y?z=1", "", "ünï", "http://a.com/x"]
    model = urls.Markov.of(pa.array(examples), 3)
    asked = ["http://a.com/y", "", "other", "ünï"]
    assert model.mean_log(pa.array(asked)) == pytest.approx([_naive_log(examples, u, 3) for u in asked])


def test_model_sums_to_one():
    model = urls.Markov.of(pa.array(["ab", "ac", "b"]), 3)
    both = sum(math.exp(n * model.mean_log(pa.array([u]))[0]) for u, n in [("", 1)])
    one = [math.exp(2 * model.mean_log(pa.array([chr(c)]))[0]) for c in range(128)]
    assert 0 < both + sum(one) < 1


def test_url_rules(spark):
    cases = {
        "http://A.Example.COM/en/1": ("a.example.com", "/en/1", "example.com/en/"),
        "https://www.example.com/en/?q": ("www.example.com", "/en/", "www.example.com/en/"),
        "http://m.www.example.com/en/x": ("m.www.example.com", "/en/x", "www.example.com/en/"),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/"),
        "http://example.com": ("example.com", "", None),
        "http://x.net/es/#f": ("x.net", "/es/", "net/es/"),
        "http://x.net/est": ("x.net", "/est", None),
        "http://x.net?a/b": ("x.net", "", None),
        "http://com/": ("com", "/", "com/"),
        "no scheme": ("", "", None),
        "a://b://c/d": ("b:", "//c/d", None),
        "": ("", "", None),
        "http://ÉX.com/\nx": ("Éx.com", "/\nx", "com/"),
    }
    rules = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}
    rows = [(i, u, "x", 1) for i, u in enumerate([*cases, None, None])]
    found = urls.judged(spark.createDataFrame(rows, "page_id long, url string, host string, row int"), rules)
    got = {r["url"]: (r["h"], r["p"], r["rule"]) for r in found.select("row.url", F.col("host").alias("h"), F.col("path").alias("p"), "rule").collect()}
    assert got == {**cases, None: ("", "", None)}
    assert {r["verdict"] for r in found.collect()} <= {"allow", "block"}
    assert found.count() == len(rows)
    none = spark.createDataFrame([], "page_id long, url string")
    assert urls.judged(none, rules).count() == 0
    assert [r["verdict"] for r in urls.judged(spark.createDataFrame([(1, "http://x.org/")], none.schema), rules).collect()] == ["allow"]


def test_url_models_tell_the_rules_apart(spark):
    rng = random.Random(1)
    rows = [(i, f"http://{rng.choice(['good', 'fine'])}{rng.randrange(99)}.{'com' if i % 2 else 'net'}/{rng.choice(['fr', 'de']) if i % 2 else 'es'}/{rng.randrange(999)}") for i in range(600)]
    rows += [(1000 + i, f"http://new{i}.org/{'de' if i % 2 else 'es'}/{i}") for i in range(40)]
    found = urls.judged(spark.createDataFrame(rows, "page_id long, url string"), {"com/": "allow", "net/": "block"})
    ratios = {r["page_id"]: r["ratio"] for r in found.select("row.page_id", "ratio").collect()}
    assert min(ratios[1000 + i] for i in range(1, 40, 2)) > max(ratios[1000 + i] for i in range(0, 40, 2))
    assert urls.calibrated(np.array([1.0, 2.0]), np.array([-1.0, 0.0])) == 0.5
    assert urls.calibrated(np.array([]), np.array([1.0])) == 0.0


def test_url_models_count_every_url(spark):
    rows = spark.range(0, 60_000, 1, 4).select(F.concat(F.lit("h://"), F.col("id"), F.when(F.col("id") % 2 == 0, ".com/").otherwise(".net/")).alias("url"))
    verdict = F.when(F.col("url").endswith("com/"), "allow").otherwise("block")
    found = urls.fitted(rows.unionByName(rows), F.col("url"), verdict)
    learned = rows.where(F.pmod(F.xxhash64("url"), F.lit(urls.HELD)) != 0)
    for model, end in ((found.accepted, "com/"), (found.rejected, "net/")):
        _, _, _, pair, count = model.levels[0]
        assert count[pair == urls.END] == [learned.where(F.col("url").endswith(end)).count()]  # was 16,000


def test_url_models_as_tables_score_as_models_in_the_tasks(spark, monkeypatch):
    monkeypatch.setattr(urls, "HOT", 20)
    rng = random.Random(2)
    rows = [(i, f"http://{rng.choice(['good', 'ünï'])}{rng.randrange(30)}.{rng.choice(['com', 'net', 'org'])}/{rng.randrange(60)}") for i in range(300)]
    pages = spark.createDataFrame([*rows, (900, None), (901, ""), (902, None), (903, "other")], "page_id long, url string").repartition(3)
    rules = {"com/": "allow", "net/": "block"}
    ruled = urls.rule_for(urls.host_of(F.col("url")), urls.path_of(F.col("url")), rules)[1]
    one, many = urls.fitted(pages, F.col("url"), ruled), urls.fitted(pages, F.col("url"), ruled, small=0)
    assert isinstance(many, urls.RatioTable) and many.threshold == pytest.approx(one.threshold, abs=1e-8)
    a, b = ({r["page_id"]: (r["ratio"], r["verdict"]) for r in urls.judged(pages, rules, small=n).select("row.page_id", "ratio", "verdict").collect()} for n in (urls.SMALL, 0))
    assert len(a) == 304 and {i: v for i, (_, v) in a.items()} == {i: v for i, (_, v) in b.items()}
    assert all(a[i][0] == pytest.approx(b[i][0], abs=1e-8) for i in a)


def test_url_threshold_over_the_cluster(spark):
    rng = np.random.default_rng(3)
    for good, bad in [(rng.normal(1, 1, 90).round(1), rng.normal(-1, 1, 70).round(1)), (np.zeros(3), np.zeros(2)), (np.zeros(0), np.ones(2)), (np.ones(4), -np.ones(1))]:
        rows = spark.createDataFrame([*((True, float(x)) for x in good), *((False, float(x)) for x in bad)], "good boolean, ratio double")
        assert urls.threshold_of(rows, 0) == pytest.approx(urls.calibrated(good, bad))
        assert urls.threshold_of(rows) == urls.calibrated(good, bad)


def _labelled(n=600):
    rng, rows = random.Random(2), []
    for i in range(n):
        sentences = [" ".join(f"w{rng.randrange(300)}" for _ in range(8)) for _ in range(rng.randrange(1, 12))]
        toxic = i % 5 == 0
        if toxic:
            sentences.insert(rng.randrange(len(sentences) + 1), f"w{rng.randrange(300)} {rng.choice(['vile', 'awful'])} w{rng.randrange(300)}")
        rows.append((i, ". ".join(sentences), toxic))
    return rows


def test_offending_sentences_are_found(spark):
    rows = _labelled()
    docs = table(spark, [(i, t, "en", "a") for i, t, _ in rows])
    labels = spark.createDataFrame([(i, int(x), 1) for i, _, x in rows], "doc_id long, toxic int, label int")
    weight = toxicity.fitted(docs, labels, ~language.held_out(F.col("doc_id"), 3, 1))
    found = toxicity.scored(docs, weight).select("row.doc_id", "row.text", F.col("score").alias("s"), "sentences").collect()
    for r in found:
        assert (r["s"] >= 0.7) == rows[r["doc_id"]][2]
        for x in r["sentences"]:
            assert {"vile", "awful"} & set(r["text"].encode()[x["first"] : x["last"]].decode().split())
        assert bool(r["sentences"]) == rows[r["doc_id"]][2]


def test_sentences_match_their_definition():
    import re

    texts = ["One two. Three!", None, "", "...", "é ü?x\ny", "a.b.c", "end"]
    words_, sentence, of, spans = toxicity.sentences_of(pa.array(texts))
    got = [[] for _ in texts]
    for t, (a, b) in zip(of, spans, strict=True):
        got[t].append(texts[t].encode()[a:b].decode())
    want = [[m.strip() for m in re.split(r"[.!?\n]", t or "") if re.search(r"[^\W_]", m)] for t in texts]
    assert got == want and len(words_) == len(sentence)


def test_toxicity_of_odd_rows(spark):
    docs = table(spark)
    none = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    weight = toxicity.fitted(docs, none, F.lit(True))
    found = toxicity.scored(docs, weight)
    assert found.count() == len(odd_texts()) and not weight.any()
    assert all(0 <= r["score"] < 0.7 for r in found.collect())
    assert {r["score"] for r in found.where("row.text is null or row.text = ''").collect()} == {0.0}
    assert toxicity.scored(docs.limit(0), weight).count() == 0
    assert not toxicity.fitted(docs.limit(0), none.limit(0), F.lit(True)).any()


def test_noisy_or_gradient():
    rng = np.random.default_rng(1)
    z, of = rng.normal(size=6), np.array([0, 0, 0, 1, 1, 2])
    label = np.array([1, 0, 1])

    def loss(z):
        clean, _ = toxicity.noisy_or(z, of, 3)
        return np.where(label > 0, -np.log(-np.expm1(-clean)), clean).sum()

    clean, p = toxicity.noisy_or(z, of, 3)
    got = np.where(label > 0, -np.exp(-clean) / -np.expm1(-clean), 1.0)[of] * p
    want = [(loss(z + d) - loss(z - d)) / 2e-6 for d in np.eye(6) * 1e-6]
    assert got == pytest.approx(want, rel=1e-4)


def _base(rows, learn):
    tokens = lambda t: [*words(t), "\n"]
    c = Counter(x for r in rows if learn(r) for x in tokens(r[1]))
    n, v = sum(c.values()), len(c)
    out = []
    for r in rows:
        t = tokens(r[1])
        out.append((r[0], len(t), sum(c[x] > 0 for x in t), n, sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in t)))
    return out


@pytest.mark.parametrize("head", [1 << 18, 50])
def test_base_scores_match_their_definition(spark, monkeypatch, head):
    monkeypatch.setattr(lm, "HEAD", head)  # with a small head most words are joined by a shuffle
    rows = odd_texts()
    learn = ~language.held_out(F.col("doc_id"), 10, 0)
    found = lm.scored(table(spark), learn).select("id", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()
    want = _base(rows, lambda r: zlib.crc32(str(r[0] if r[0] is not None else "").encode()) % 10 != 0)
    key = lambda r: (repr(r[0]), r[1], round(r[4], 3))
    for g, w in zip(sorted(found, key=key), sorted(want, key=key), strict=True):
        assert tuple(g)[:4] == w[:4] and g["base_score"] == pytest.approx(w[4], rel=1e-9) and g["score"] < 0


def _held_scores(docs):
    found = lm.scored(docs, ~language.held_out(F.col("doc_id"), 10, 0))
    return sorted((r["id"], r["th"], r["score"], r["base_score"], r["n_tokens"]) for r in found.collect())


def test_model_beats_word_counts_and_partitions_do_not_matter(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    one, many = _held_scores(docs.coalesce(1)), _held_scores(docs.repartition(8))
    for a, b in zip(one, many, strict=True):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-6) and a[3] == pytest.approx(b[3], rel=1e-9)
    held = [r for r in one if zlib.crc32(str(r[0]).encode()) % 10 == 0]
    gain = (sum(r[2] for r in held) - sum(r[3] for r in held)) / sum(r[4] for r in held)
    assert gain > 0.2  # log10 per token


@pytest.mark.parametrize("head", [1 << 18, 300])
def test_scores_are_those_of_single_tokens(spark, monkeypatch, head):
    monkeypatch.setattr(lm, "HEAD", head)
    monkeypatch.setattr(lm, "LEAST_TOP", 100)
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").limit(60)
    learn = ~language.held_out(F.col("doc_id"), 10, 0)
    made = {}
    real = lm.fitted
    monkeypatch.setattr(lm, "fitted", lambda texts: made.setdefault("fit", real(texts)))
    found = {r["id"]: r["score"] for r in lm.scored(docs, learn).collect()}
    vocab, _, model, masses = made["fit"]
    assert masses.sum() == pytest.approx(vocab.total + 0.1 * (vocab.distinct + vocab.tail), rel=1e-9)
    rows = docs.collect()
    counts = Counter(int(v) for r in rows if zlib.crc32(str(r[0]).encode()) % 10 for v in lm.with_ends(pa.array([r[1]], pa.string()))[1])
    before, after, place, bias = (p.astype(float) for p in model.parts)
    for r in rows:
        _, value, kind, _ = lm.with_ends(pa.array([r[1]], pa.string()))
        cls = [int(c) for c in vocab.classes_of(kind, *vocab.find(value))]
        total, begin = 0.0, vocab.classes
        for i, c in enumerate(cls):
            one, two = (cls[i - k] if i >= k else begin for k in (1, 2))
            score = (before[one] @ place[0] + before[two] @ place[1]) @ after.T + bias
            share = score[c] - score.max() - math.log(np.exp(score - score.max()).sum())
            total += share / math.log(10) + math.log10(counts[int(value[i])] + 0.1) - math.log10(masses[c])
        assert found[r[0]] == pytest.approx(total, rel=1e-4)


def test_model_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    model = lm.fresh_model(rng.random(200) + 0.1)
    learner = lm.Learner(model, 0.1, 1)
    learner.learn(*rng.integers(0, 200, (3, 5000)), np.ones(5000))
    scorer = lm.Scorer(lm.Model(learner.parts, model.log_noise), np.ones(200))
    for one, two in rng.integers(0, 201, (5, 2)):
        shares = scorer.log_shares(np.full(200, one), np.full(200, two), np.arange(200))
        assert (10.0**shares).sum() == pytest.approx(1, abs=1e-4)


def test_normalisers_with_and_without_a_table_agree(monkeypatch):
    rng = np.random.default_rng(3)
    model = lm.fresh_model(rng.random(50) + 0.1)
    one, two = rng.integers(0, 51, (2, 1000))
    table_ = lm.Scorer(model, np.ones(50)).normaliser(one, two)
    monkeypatch.setattr(lm, "MOST_CONTEXTS", 0)
    assert np.allclose(lm.Scorer(model, np.ones(50)).normaliser(one, two), table_, atol=1e-5)


def test_normalisers_of_many_classes_come_from_matrix_products(monkeypatch):
    rng = np.random.default_rng(5)
    model = lm.fresh_model(rng.random(4200) + 0.1)
    one, two = rng.integers(0, 4201, (2, 300))
    want = model.normalisers(one, two)
    monkeypatch.setattr(lm.Model, "normalisers", None)  # one exponential per context and class, and beyond 4,095 classes again for each batch of texts
    bands = [model.band(one[a : a + 50], two) for a in range(0, 300, 50)]
    assert np.allclose(np.concatenate(bands).diagonal(), want, atol=1e-5)


@pytest.mark.parametrize("most", [0, 1, 20**2, 51**2])
def test_contexts_outside_the_table_are_normalised_alike(spark, monkeypatch, most):
    rng = np.random.default_rng(4)
    masses = rng.random(50) + 0.1
    model = lm.fresh_model(masses)
    one, two = rng.integers(0, 51, (2, 1000))
    monkeypatch.setattr(lm, "MOST_CONTEXTS", most)
    monkeypatch.setattr(lm, "BAND", 7)
    held = lm.tabled(masses)
    assert len(held) == min(51, most**0.5) and (not most or 50 in held)
    scorer = lm.Scorer(model, masses, held, lm.normaliser_table(spark, model, held))
    assert np.allclose(scorer.normaliser(one, two), model.normalisers(one, two), atol=1e-5)


def test_normalisers_hold_where_products_vanish():
    model = lm.fresh_model(np.ones(40))
    model.parts[0][:] = 0
    model.parts[1][:] = 0
    model.parts[1][0, 0], model.parts[1][1, 1] = 1, 1
    model.parts[0][0, 0], model.parts[0][1, 1] = 300, 600  # each place is sure of another class
    every = np.arange(41)
    found = model.band(every, every)
    assert found[0, 1] == pytest.approx(600 / 2, abs=5) and np.isfinite(found).all()
    assert np.allclose(found.ravel(), model.normalisers(every.repeat(41), np.tile(every, 41)), rtol=1e-5)


def test_a_step_changes_the_rows_it_met_and_no_other():
    rng = np.random.default_rng(6)
    model = lm.fresh_model(rng.random(3000) + 0.1)
    learner = lm.Learner(model, 0.1, 1)
    at, grad = rng.integers(0, 30, 500), rng.normal(size=(500, lm.WIDTH)).astype(np.float32)
    total = np.zeros((3000, lm.WIDTH))
    np.add.at(total, at, grad.astype(float))
    squares = 1e-3 + (total.astype(np.float32) ** 2).mean(axis=1)
    want = model.parts[1] + (np.float32(0.1) / np.sqrt(squares))[:, None] * total
    rows, place = learner._met(at)
    assert len(rows) == len(np.unique(at)) and (rows[place] == at).all()
    learner._add(1, at, grad)
    assert np.allclose(learner.parts[1], want, atol=1e-5) and (learner.parts[1] != model.parts[1]).any(axis=1).sum() == len(rows)


def test_trained_model_recovers_conditional_probabilities():
    rng = np.random.default_rng(2)
    one = rng.integers(0, 4, 20_000)
    own = np.where(rng.random(20_000) < 0.9, (one + 1) % 4, rng.integers(0, 4, 20_000))
    triples, counts = np.unique(np.stack([np.zeros_like(one), one, own], axis=1), axis=0, return_counts=True)
    model = lm.fresh_model(np.full(4, 5000.0))
    learner = lm.Learner(model, 0.1, 1)
    for _ in range(1500):
        learner.learn(triples[:, 0], triples[:, 1], triples[:, 2], counts)
    scorer = lm.Scorer(lm.Model(learner.parts, model.log_noise), np.ones(4))
    for k in range(4):
        assert 10 ** float(scorer.log_shares(np.array([k]), np.array([0]), np.array([(k + 1) % 4]))[0]) == pytest.approx(0.925, abs=0.1)


def test_language_model_without_training_rows(spark):
    docs = table(spark)
    assert lm.scored(docs, F.lit(False)).agg(F.max("n_known")).first()[0] == 0
    assert lm.scored(docs.limit(0), F.lit(True)).count() == 0


def _chained(texts: int) -> list[tuple]:
    """400 words, all with one ending, each always followed by a word of its own."""
    rng = random.Random(3)
    talk = lambda: " ".join(f"a{k}xx b{k}xx" for k in rng.choices(range(200), k=100))
    return [(i, talk()) for i in range(texts)]


def test_words_with_a_class_of_their_own_are_learned(spark):
    docs = spark.createDataFrame(_chained(1200), "doc_id long, text string").repartition(4)
    r = lm.scored(docs, F.col("doc_id") % 10 > 0).where("id % 10 = 0").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert (r[0] - r[1]) / r[2] > 0.5


def test_classes_grow_with_the_words():
    assert lm.class_numbers(0) == (512, 48)
    assert lm.class_numbers(10**8) == (12_500, 2_500)


def test_learners_share_triples_alike(spark, monkeypatch):
    monkeypatch.setattr(lm, "SHARE_BITS", 12)  # several learners
    monkeypatch.setattr(lm, "BUCKET_BITS", 12)
    texts = spark.read.parquet(f"{DATA}/documents.parquet").select("text").limit(200)
    found = []
    for parts in (texts.coalesce(1), texts.repartition(7)):
        counts = parts.mapInArrow(lm._count, "h long, c long, kind int").groupBy("h").agg(F.sum("c").alias("c"), F.min("kind").alias("kind"))
        vocab, _ = lm.vocabulary(counts)
        triples = lm.counted_triples(parts, vocab)
        held = [np.frombuffer(r["c"], np.int32).sum() for r in triples.collect()]
        assert sum(held) == vocab.total and triples.select("bucket").distinct().count() > 5
        found.append(lm.learned(lm.fresh_model(lm.class_masses(counts, vocab)), triples).parts)
    assert all(np.allclose(x, y, rtol=1e-6, atol=1e-7) for x, y in zip(*found, strict=True))
