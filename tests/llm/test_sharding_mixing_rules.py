import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from popflow.llm import cascade, mixing, shuffle
from popflow.llm.common import bucket_of, n_words_of, word_hashes

TEXTS = [
    "", None, " \t\n", "one", "a b c d e a b c d e x", "This This This This This This",
    "A line with words.\nA line with words.\nAnother one.\n\n", "x# y$ *z | |", "word " * 400,
    "LOUD WORDS HERE AND THERE ALL OVER THE PLACE AGAIN NOW", "é ñ ü a b c d e f g h i j k l m n",
    "plain words that say nothing twice and go on for a while longer",
]


def test_word_hashes_follow_words():
    texts = [(t or "").encode() for t in TEXTS] + [b"y" * 300_000 + b" one"]
    hashes, counts = word_hashes(texts)
    words = [w for t in texts for w in t.split()]
    assert counts.tolist() == [len(t.split()) for t in texts]
    assert len(set(zip(words, hashes.tolist()))) == len(set(words)) == len(set(hashes.tolist()))


def test_shuffle_has_exact_sizes_and_no_gaps(spark):
    rows = [(i // 3, f"t{i % 50}", i) for i in range(1003)] + [(None, None, -1)] * 200
    df = spark.createDataFrame(rows, "doc_id long, text string, shard long")
    got = shuffle.shuffle_to_shards(df, 7, ["doc_id", "text"], rows_per_block=100, min_blocks=3)
    assert got.columns == ["doc_id", "text", "shard", "slot"]
    sizes = Counter(r.shard for r in got.collect())
    assert sorted(sizes) == list(range(7)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r.slot for r in got.filter(F.col("shard") == shard).collect()) == list(
            range(n))
    key = ["doc_id", "text", "shard", "slot"]
    again = shuffle.shuffle_to_shards(
        df.repartition(5), 7, ["doc_id", "text"], rows_per_block=100, min_blocks=3)
    assert Counter(map(tuple, got.select(key).collect())) == Counter(
        map(tuple, again.select(key).collect()))
    assert shuffle.shuffle_to_shards(df.limit(0), 3, ["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        shuffle.shuffle_to_shards(df, 0, ["doc_id"])


def test_matrix_has_the_law_of_a_draw_without_replacement(monkeypatch):
    sizes = shuffle.shard_sizes(100, 3)
    m = shuffle.communication_matrix([40, 0, 35, 25], sizes, 5)
    assert m.sum(axis=1).tolist() == [40, 0, 35, 25] and m.sum(axis=0).tolist() == [34, 33, 33]
    draws = [shuffle.communication_matrix([40, 60], sizes, s)[0, 0] for s in range(400)]
    assert np.mean(draws) == pytest.approx(40 * 34 / 100, abs=0.4)
    monkeypatch.setattr(shuffle, "_LIMIT", 50)  # own inversion, groups of blocks
    rng = np.random.default_rng(0)
    own = [shuffle.hypergeometric(rng, 34, 66, 40) for _ in range(4000)]
    assert np.mean(own) == pytest.approx(13.6, abs=0.2)
    assert np.var(own) == pytest.approx(40 * .34 * .66 * 60 / 99, rel=0.12)
    m = shuffle.communication_matrix([40, 0, 35, 25], sizes, 5)
    assert m.sum(axis=1).tolist() == [40, 0, 35, 25] and m.sum(axis=0).tolist() == [34, 33, 33]


def brute_repeats(text):
    w = text.split()
    seen = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    hit = {j for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    return len(hit)


def test_rule_measures_against_plain_python(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    t = F.coalesce("text", F.lit(""))
    got = df.select("text", *[f(t).alias(f.__name__) for f in (
        cascade.n_words, cascade.word_chars, cascade.n_symbols, cascade.n_dup_lines,
        cascade.n_stutters, cascade.n_repeat_words, cascade.upper_share)]).collect()
    for r in got:
        text = r.text or ""
        words = text.split()
        lines = [x for x in text.split("\n") if x.split()]
        letters = [c for c in text if c.isalpha()]
        assert r.n_words == len(words) and r.word_chars == sum(map(len, words))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", text))
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.n_stutters == sum(a == b for a, b in zip(words, words[1:]))
        assert r.n_repeat_words == brute_repeats(text)
        assert r.upper_share == pytest.approx(
            sum(c.isupper() for c in letters) / max(1, len(letters)))


def test_cascade_order_changes_the_work_not_the_verdict(spark):
    df = spark.createDataFrame(
        [(i, t, "old") for i, t in enumerate(TEXTS)], "doc_id long, text string, broken_rule string")
    got = {r.doc_id: r.broken_rule for r in cascade.apply_rules(df).collect()}
    ways = [df.select("doc_id", cascade.first_broken(F.col("text"), order).alias("b")).collect()
            for order in (cascade.RULES, cascade.RULES[::-1])]
    for way in ways:
        assert {r.doc_id: r.b is None for r in way} == {k: v is None for k, v in got.items()}
    assert got[len(TEXTS) - 1] is None and got[0] == got[1] == "few_words"
    assert got[9] == "shouting"
    figures = {"few_words": (1.0, 0.5), "symbols": (0.1, 0.4), "stutter": (9.0, 0.0),
               "shouting": (1.0, 0.0), "repeated_windows": (5.0, 0.9), "repeated_lines": (2., 0.)}
    assert [r.name for r in cascade.in_order(cascade.RULES, figures)] == [
        "symbols", "few_words", "repeated_windows", "shouting", "repeated_lines", "stutter"]
    assert cascade.apply_rules(df.limit(0)).count() == 0


def test_targets_stop_at_three_times_the_size(spark):
    sizes = spark.createDataFrame(
        [("a", 10), ("b", 1000), ("c", 500), (None, 90), ("", 0)],
        "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    # Order: empty, a, b, c, null; weights 5, 2, 1, 5, 2.
    assert got[""] == 0 and got["a"] == 30 and got[None] == 270
    assert sum(got.values()) == pytest.approx(1600)
    assert got["c"] / got["b"] == pytest.approx(5) and got["c"] <= 1500


def test_mixing_takes_what_is_asked_for(spark):
    rows = [(i, f"s{i % 4}" if i % 3 else "s0", "w " * (1 + i % 40)) for i in range(2000)]
    rows += [(None, None, None), (None, None, "x y"), (5, "", "z")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn(
        "n", n_words_of(F.col("text"))).withColumn("target", F.lit("clash"))
    got = mixing.mix_sources(df, "n", rows_per_part=100).toPandas()
    assert len(got) == len(rows) and got["copies"].between(0, 3).all()
    got["taken"] = got["copies"] * got["n"]
    for source, part in got.dropna(subset=["source"]).groupby("source"):
        if len(part) > 50:
            assert part["taken"].sum() == pytest.approx(part["target"].iloc[0], rel=0.05), source
    again = mixing.mix_sources(df.repartition(3), "n", rows_per_part=100).toPandas()
    key = ["doc_id", "source", "n", "copies"]
    assert Counter(map(str, got[key].values.tolist())) == Counter(
        map(str, again[key].values.tolist()))
    assert mixing.mix_sources(df.limit(0), "n").count() == 0


def test_buckets_are_crc32_of_the_id(spark):
    import zlib
    df = spark.range(20).withColumn("b", bucket_of(F.col("id"), 5))
    assert all(r.b == zlib.crc32(str(r.id).encode()) % 5 for r in df.collect())
