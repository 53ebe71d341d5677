import math
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from popflow.llm import cascade, elias_fano, labels, ngram_lm, pu_quality, toxicity

WORDS = [f"{a}{b}" for a in ("ba", "ko", "mi", "tu", "re", "sol") for b in "aeioulnrst"]


def prose(rng, n, extra=()):
    words = list(rng.choice(WORDS, n, p=1 / np.arange(1, 61) / (1 / np.arange(1, 61)).sum()))
    for w in extra:
        words[int(rng.integers(n))] = w
    return ". ".join(" ".join(words[i:i + 8]).capitalize() for i in range(0, n, 8)) + "."


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(3)
    docs, labels = [], []
    for i in range(400):
        toxic, junk = i % 5 == 0, i % 7 == 3
        text = prose(rng, int(rng.integers(20, 200)),
                     rng.choice(["scoundrel", "rotter", "swine"], 2) if toxic else ())
        if junk:
            text = " ".join(w + "%%%" for w in text.split())
        docs.append((i, text, "clash"))
        if i % 4:
            labels.append((i, int(not junk), int(toxic)))
    docs += [(1000, None, "c"), (1001, "", "c"), (None, "some text", "c"), (1002, "w " * 5000, "c")]
    labels += [(1, None, None), (None, 1, 1), (3, 1, 0), (3, 0, 1)]  # unknown and contradicting
    return (spark.createDataFrame(docs, "doc_id long, text string, toxicity string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_toxic_expressions_are_learnt(labelled):
    docs, labels = labelled
    model = toxicity.fit(docs, labels, F.coalesce(F.col("doc_id"), F.lit(0)) % 3 != 0)
    got = toxicity.score(docs, model).toPandas().set_index("doc_id")
    assert list(got.columns) == ["toxicity"] and got["toxicity"].between(0, 1).all()
    clear = got.index.notna() & (got.index < 400) & (got.index % 7 != 3)
    held = got[clear & (got.index % 3 == 0)]["toxicity"]
    truth = held.index % 5 == 0
    assert ((held >= 0.5) == truth).mean() > 0.95
    assert got.loc[1000, "toxicity"] == got.loc[1001, "toxicity"]


def test_toxicity_keeps_the_odds_of_the_whole_table(spark):
    # A quarter of the documents with the word are toxic, however few ordinary ones are taken.
    rows = [(i, " ".join(f"u{i}x{j}" for j in range(20)) + (" swine" if i < 800 else ""), int(
        i < 800 and i % 4 == 0)) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    means = []
    for max_docs in (10_000, 600):
        model = toxicity.fit(df, df, F.lit(True), max_docs=max_docs, margin=1.0)
        got = toxicity.score(df, model).filter("doc_id < 800")
        means.append(got.agg(F.avg("toxicity")).first()[0])
    assert means == pytest.approx([0.25, 0.25], abs=0.12)


def test_toxicity_without_labels_is_even(labelled):
    docs, labels = labelled
    model = toxicity.fit(docs, labels.limit(0), F.lit(True))
    assert set(toxicity.score(docs, model).toPandas()["toxicity"]) == {0.5}
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_quality_from_positives_and_unlabelled(labelled):
    docs, labels = labelled
    network = pu_quality.fit(docs, labels, F.lit(True))
    got = pu_quality.score(docs, network).toPandas().set_index("doc_id")["goodness"]
    known = got[got.index.notna() & (got.index < 400)]
    truth = known.index % 7 != 3
    assert ((known >= 0.7) == truth).mean() > 0.97
    assert 0.6 < network.prior <= 0.98 and got.between(0, 1).all()
    # The columns compute what the network does.
    x = np.array(docs.select(F.array(*pu_quality.features(F.col("text"))).alias("x")).filter(
        "true").toPandas()["x"].tolist())
    z = pu_quality._forward(np.clip((x - network.mean) / network.scale, -6, 6), network.inner,
                            network.outer)[1]
    want = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    np.testing.assert_allclose(pu_quality.score(docs, network).toPandas()["goodness"], want,
                               atol=1e-9)


def test_quality_without_positives(labelled):
    docs, labels = labelled
    assert pu_quality.fit(docs, labels.filter("quality = 0"), F.lit(True)) is None
    assert set(pu_quality.score(docs, None).toPandas()["goodness"]) == {0.5}


def test_class_prior_of_a_known_mixture():
    rng = np.random.default_rng(0)
    positive = rng.normal(3, 1, 4000)
    mixed = np.r_[rng.normal(3, 1, 2800), rng.normal(-3, 1, 1200)]
    assert pu_quality.class_prior(positive, mixed) == pytest.approx(0.7, abs=0.05)


@pytest.mark.parametrize("values", [
    [], [0], [2 ** 64 - 1], [0, 0, 0, 9], list(range(0, 3000, 7)), [5] * 1000 + [1 << 40]])
def test_elias_fano(values):
    v = np.array(values, np.uint64)
    seq = elias_fano.EliasFano(*elias_fano.EliasFano.encode(v))
    assert (seq.slice(0, len(v)) == v).all()
    wanted = np.unique(np.r_[v, v // np.uint64(2)])
    at, equal = seq.successors(wanted)
    assert (at == np.searchsorted(v, wanted)).all() and (equal == np.isin(wanted, v)).all()
    if len(v):
        some = np.arange(0, len(v), 3)
        assert (seq.take(some) == v[some]).all()


def brute_model(docs, train):
    """Kneser-Ney of order 2 with plain dictionaries: (tokens, known, base, score) by id."""
    tokens = {i: [w.decode() for w in (t or "").encode().lower().split()] + ["</s>"]
              for i, t in docs}
    count, pair = Counter(), Counter()
    for i in train:
        count.update(tokens[i])
        pair.update(zip(["<s>"] + tokens[i][:-1], tokens[i]))
    n, v = sum(count.values()), len(count)
    before, total, kinds = Counter(w for _, w in pair), Counter(), Counter()
    for (a, _), c in pair.items():
        total[a] += c
        kinds[a] += 1
    times = [Counter(before.values()), Counter(pair.values())]
    d1, d2 = (ngram_lm.discount(t[1], t[2]) for t in times)
    out = {}
    for i, t in tokens.items():
        score = 0.0
        for a, w in zip(["<s>"] + t[:-1], t):
            p = max(before[w] - d1, 0) / max(len(pair), 1) + (
                d1 * v / len(pair) if pair else 1.0) / (v + 1)
            if total[a]:
                p = max(pair[a, w] - d2, 0) / total[a] + d2 * kinds[a] / total[a] * p
            score += math.log10(p)
        base = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        out[i] = (len(t), sum(count[w] > 0 for w in t), base, score)
    return n, out


def test_language_model_against_dictionaries(spark, monkeypatch):
    rng = np.random.default_rng(1)
    docs = [(i, prose(rng, int(rng.integers(1, 80)))) for i in range(60)]
    docs += [(60, None), (61, ""), (62, "never seen before"), (63, "baa " * 3000)]
    train = [i for i, _ in docs if i % 3]
    n, want = brute_model(docs, train)
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, score string")
    for shard_bytes, batch, buffer in ((1 << 20, 1 << 20, 1 << 20), (500, 700, 50)):
        monkeypatch.setattr(ngram_lm, "BATCH_BYTES", batch)
        monkeypatch.setattr(ngram_lm, "BUFFER_EVENTS", buffer)
        got = ngram_lm.score_documents(
            df.withColumn("train", F.col("doc_id") % 3 != 0), F.col("train"),
            shard_bytes=shard_bytes).toPandas()
        assert len(got) == len(docs) and set(got["train_tokens"]) == {n}
        for r in got.itertuples():
            size, known, base, score = want[r.doc_id]
            assert (r.n_tokens, r.n_known) == (size, known)
            assert r.base_score == pytest.approx(base, rel=1e-9)
            assert abs(r.score - score) < 0.02 * size  # levels are quantised


def test_language_model_without_training(spark):
    df = spark.createDataFrame([(None, "a b"), (2, None), (2, None)], "doc_id long, text string")
    got = ngram_lm.score_documents(df, F.lit(False)).toPandas()
    assert sorted(got["n_tokens"]) == [1, 1, 3] and set(got["train_tokens"]) == {0}
    assert (got["n_known"] == 0).all() and np.isfinite(got["score"]).all()
    assert ngram_lm.score_documents(df.limit(0), F.lit(True)).count() == 0
    assert isinstance(got, pd.DataFrame)


def test_scores_of_odd_rows(spark):
    """Columns named like those inside the scorer, repeated rows, a very long text, no rows."""
    rows = [(i, f"calm words about gardens {i} and rivers" if i % 2 else f"vile nasty filth {i} scum",
             i, "kept") for i in range(40)]
    rows += [(40, None, 1, "kept"), (40, None, 1, "kept"), (41, "vile nasty filth " * 50_000, 2, "kept")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, words int, evidence string")
    labels = spark.createDataFrame(
        [(i, 1 - i % 2, i % 2) for i in range(40)], "doc_id long, toxic int, quality int")
    model = toxicity.fit(docs, labels, F.lit(True))
    got = toxicity.score(docs, model)
    assert got.columns == ["doc_id", "words", "evidence", "toxicity"]
    by_id = got.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.min("toxicity").alias("a"),
                                      F.max("toxicity").alias("b")).collect()
    assert sum(r.n for r in by_id) == len(rows) and all(r.a == r.b and 0 <= r.a <= 1 for r in by_id)
    assert got.filter("words IS NULL OR evidence != 'kept'").isEmpty()
    assert toxicity.score(docs.limit(0), model).count() == 0
    network = pu_quality.fit(docs, labels, F.lit(True))
    assert pu_quality.score(docs.limit(0), network).count() == 0
    assert cascade.apply_rules(docs.limit(0)).count() == 0


def test_toxicity_learns_from_every_labelled_document(spark):
    """No class is cut to a number of documents."""
    n = 45_000
    docs = spark.range(n).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 2 == 0, F.concat(F.lit("rotter w"), F.col("id") % 50))
        .otherwise(F.concat(F.lit("plain w"), F.col("id") % 50)).alias("text"),
        (F.col("id") % 2 == 0).cast("int").alias("toxic"))
    counted = []
    count = toxicity._log_ratios
    try:
        toxicity._log_ratios = lambda pairs, *rest: (
            counted.append(pairs.agg(F.sum(F.col("toxic") + F.col("plain"))).first()[0])
            or count(pairs, *rest))
        toxicity.fit(docs, docs, F.lit(True))
    finally:
        toxicity._log_ratios = count
    folds = docs.filter(F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(4)) > 0).count()
    assert counted == [2 * folds]  # two pairs a document


def test_curve_matches_one_table(spark):
    rng = np.random.default_rng(2)
    x, n = rng.normal(0, 0.05, 300), rng.integers(1, 90, 300)
    y = (rng.random(300) < 1 / (1 + np.exp(-40 * x))).astype(int)
    held = spark.createDataFrame(
        [(int(a), 1.0 + i % 3, float(b), int(c)) for i, (a, b, c) in enumerate(zip(y, x, n))],
        "label int, weight double, evidence double, words bigint").repartition(5)
    w, z = np.array(toxicity._fit_curve(held)), toxicity._spread(x, n)
    p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
    slope = z.T @ ((1.0 + np.arange(300) % 3) * (p - y)) + np.array([1e-2, 1e-2, 1e-4]) * w
    assert np.abs(slope).max() < 1e-6


def test_only_texts_that_may_have_a_label_move(spark):
    ids = spark.range(0, 20_000, 40).withColumnRenamed("id", "doc_id")
    docs = spark.range(20_000).withColumnRenamed("id", "doc_id").withColumn("text", F.lit("a b"))
    some = labels.perhaps_in(docs, ids)
    assert some.columns == docs.columns
    assert some.join(ids, "doc_id").count() == 500
    assert some.count() < 600
    assert labels.perhaps_in(docs, ids.limit(0)).count() == 0
    other = ids.select(F.col("doc_id").cast("int"))  # hashes of other types differ
    assert labels.perhaps_in(docs, other).count() == 20_000


def test_pairs_of_a_word_are_exchanged_once(spark):
    docs = spark.range(300).select(
        F.col("id").alias("doc_id"),
        F.concat_ws(" ", F.lit("the"), F.concat(F.lit("w"), F.col("id") % 97)).alias("text"),
        (F.col("id") % 2).cast("int").alias("toxic"))
    seen, whole = [], toxicity._log_ratios
    try:
        toxicity._log_ratios = lambda pairs, *rest: seen.append(pairs) or whole(pairs, *rest)
        toxicity.fit(docs, docs, F.lit(True))
    finally:
        toxicity._log_ratios = whole
    pairs = seen[0]
    plan = pairs.groupBy("word", "part").count()._jdf.queryExecution().executedPlan().toString()
    # One exchange for each side of the join with the labels, one for the pairs and their words, and
    # one for the maps of ids.
    assert plan.count("Exchange hashpartitioning(word") == 1, plan
    assert "before#" not in plan.split("Exchange hashpartitioning(word")[1].split("[plan_id")[0].split(
        ")")[0], plan
    assert "BroadcastHashJoin [doc_id" not in plan, plan
    got = pairs.groupBy("word").agg(F.count_distinct("before").alias("n"), F.count(F.lit(1)).alias("m"))
    assert got.filter("n != m").count() == 0


def test_every_word_has_its_log_ratio(spark):
    """No word is left out for a weak ratio: as two plain Kneser-Ney models over dictionaries say."""
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(rng.choice(WORDS + (["rotter"] if i % 3 == 0 else []), 30)), int(i % 3 == 0))
            for i in range(240)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(df, df, F.lit(True))
    learnt = {r.doc_id for r in df.filter(
        F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(4)) > 0).collect()}
    before = {c: {} for c in (0, 1, 2)}  # 2: both
    for i, text, label in rows:
        if i in learnt:
            for a, b in zip([None, *text.split()], text.split()):
                for c in (label, 2):
                    before[c].setdefault(b, set()).add(a)
    n = {c: sum(map(len, before[c].values())) for c in before}
    kept = {c: {w: max(len(v) - 2.0, 0) for w, v in before[c].items()} for c in (0, 1)}

    def probability(word, c):
        shared = (len(before[2].get(word, ())) + 0.5) / (n[2] + 0.5 * len(before[2]))
        return kept[c].get(word, 0) / n[c] + (1 - sum(kept[c].values()) / n[c]) * shared

    def ratio(word):
        return np.log(probability(word, 1) / probability(word, 0))

    texts = [text for _, text, _ in rows[:40]] + ["never seen words", "", WORDS[0]]
    found, counts = toxicity.evidence([x.encode() for x in texts], model)
    want = [sum(map(ratio, x.split())) / max(len(x.split()), 1) for x in texts]
    np.testing.assert_allclose(found.sum(axis=1), want, atol=1e-6)
    weak = [w for w in WORDS if 0 < abs(ratio(w)) < toxicity.MARGIN]
    assert len(weak) > 50 and toxicity.evidence([weak[0].encode()], model)[0].any()
