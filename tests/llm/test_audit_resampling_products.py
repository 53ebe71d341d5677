import hashlib
import math
import random
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from popflow.llm import audit, importance, inner_products

# --- filter audit

LONG = " ".join(f"word{i}" for i in range(210))
DOCS = [
    (1, LONG, "en"), (2, LONG, "en"), (3, LONG, "de"), (3, LONG, "de"), (3, LONG + "!", "de"),
    (4, "", None), (5, None, "en"), (6, "", ""), (7, "LOUD AND SHORT", "en"),
    (8, "same " * 300, "en"), (9, "same " * 300 + "|", "fr"), (10, LONG + " $", "fr"),
    (None, LONG, "en"), (None, LONG, "en"), (11, "LOUD AND SHORT", None),
    (12, LONG.upper() + " " + "x" * 200_000, "en"), (2, "z", "en"), (13, "z", "en"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (3, 0, 1), (8, None, 1), (8, 1, None), (None, 1, 1), (99, 1, 1)]


def brute_audit(docs, labels):
    marks = {}
    for key, quality, toxic in labels:
        good, bad = marks.get(key, (False, False))
        marks[key] = good or quality == 1, bad or toxic == 1
    rows = []
    for key, text, part in docs:
        t = text or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
        failed = {f for f, bad in {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": re.search("[#$%&*|]", t),
            "E": key is not None and any(
                k is not None and k < key and (x or "") == t for k, x, _ in docs)}.items() if bad}
        good, toxic = marks.get(key, (False, False)) if key is not None else (False, False)
        rows.append((part or "", failed, good, toxic))
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                removed = [r for r in left if f in r[1]]
                before = set(order[:step - 1])
                left = [r for r in left if f not in r[1]]
                shapley[f] += len(removed)
                out[part, "".join(order), step] = [
                    len(left), len(removed),
                    sum(f in r[1] and bool(r[1] & before) for r in mine),
                    sum(r[1] == {f} for r in mine), sum(r[2] for r in removed),
                    sum(r[3] for r in removed)]
        for (p, order, step), values in out.items():
            if p == part:
                values.append(shapley[order[step - 1]])
    return out


@pytest.mark.parametrize("rows_per_salt", [1, 4096])
def test_audit_against_brute_force(spark, monkeypatch, rows_per_salt):
    monkeypatch.setattr(audit.repeated_texts, "__defaults__", ((), "doc_id", "text", rows_per_salt))
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, lang string").withColumns(
        {c: F.lit("?") for c in ("part", "failed", "rows", "hash", "id", "t", "salts")})
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    got = {(r.part, r.filter_order, r.step): list(r[3:]) for r in audit.audit(docs, labels).collect()}
    assert got == brute_audit(DOCS, LABELS)
    assert audit.audit(docs.limit(0), labels).count() == 0


def test_equal_hashes_do_not_make_equal_texts(spark, monkeypatch):
    """With one hash for all texts only the exact comparison tells copies."""
    monkeypatch.setattr(audit.F, "xxhash64", lambda *c: F.lit(7).cast("bigint"))
    docs = spark.createDataFrame(
        [(i, f"text {i % 7}" if i < 20 else f"own {i}") for i in range(40)], "doc_id long, text string")
    found = audit.repeated_texts(docs, docs.select(
        F.col("doc_id").alias("id"), F.lit(7).cast("bigint").alias("hash")), rows_per_salt=3)
    assert sorted(r.id for r in found.collect()) == list(range(7, 20))


# --- importance resampling

def brute_runs(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+",
                       re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return words, [zlib.crc32(" ".join(words[i:i + k]).encode()) % 10_000
                   for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def some_texts(n, seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abAB9é日_-") for _ in range(rng.randint(1, 12)))
             for _ in range(60)]
    return [rng.choice([" ", "\n", ". ", "\t\x01 "]).join(
        rng.choice(words) for _ in range(rng.randint(0, 60))) for _ in range(n)] + [
            "", "x" * 500 + " " + "y" * 70 + " b", "one", " lead", "trail  ", "ÀÉ Éa É"]


@pytest.mark.parametrize("span", [1, 7, 50, 1000, 1 << 22])
def test_buckets_of_runs_from_payloads(span):
    texts = some_texts(80)
    got = [[] for _ in texts]
    for of, bucket in importance.run_buckets([t.encode() for t in texts], span):
        for i, b in zip(of.tolist(), bucket.tolist()):
            got[i].append(b)
    assert [sorted(g) for g in got] == [sorted(brute_runs(t)[1]) for t in texts]
    assert not list(importance.run_buckets([], span))


def test_checksums_shift_by_any_length():
    for word in (b"a", b"b" * 63, b"c" * 64, b"d" * 5000):
        size = np.array([len(word)])
        whole = importance.shifted(np.array([zlib.crc32(b"before")], np.uint32), size)
        assert int(whole[0]) ^ zlib.crc32(word) == zlib.crc32(b"before" + word)


def test_resampling_against_brute_force(spark):
    texts = some_texts(150)
    rows = [(i, t, 0, "x") for i, t in enumerate(texts)] + [
        (None, texts[3], 0, "x"), (None, None, 0, "x"), (7, texts[7], 0, "x"), (7, texts[7], 0, "x"),
        (1000, "long word " * 40_000, 0, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, weight int, key string")
    target = spark.createDataFrame(
        [(t,) for t in some_texts(20, 1)[:20]] + [(None,)], "text string")
    runs = [brute_runs(r[1]) for r in rows]
    s, t = Counter(), Counter()
    for _, found in runs:
        s.update(found)
    for r in target.collect():
        t.update(brute_runs(r.text)[1])
    gain = {b: math.floor(1000 * math.log(
        (t[b] + 1) * (s.total() + 10_000) / ((s[b] + 1) * (t.total() + 10_000)))) for b in s}
    want = []
    for (key, *_), (words, found) in zip(rows, runs):
        name = f"42:{'' if key is None else key}".encode()
        h = int(hashlib.sha256(name).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        want.append([key, len(words), len(found), weight, weight + math.floor(
            -1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((w for w in want if w[1] >= 20),
                  key=lambda w: (-w[4], w[0] is None, w[0] or 0, w[2], w[3]))
    for i, w in enumerate(able):
        w.append(i + 1 if i < len(able) * 20 // 100 else None)
    want = [w if len(w) == 6 else [*w, None] for w in want]
    got = importance.resample(docs, target, percent=20)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want))
    assert importance.resample(docs.limit(0), target).count() == 0
    assert importance.resample(docs, target.limit(0)).count() == len(rows)


# --- largest inner products

def brute_products(rows, k=5):
    taken = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
             if i is not None and v is not None and all(
                 x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in taken:
        if i % 50 == 0:
            queries[i] = min(queries.get(i, v), v)
    out = []
    for i, q in queries.items():
        best = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in taken if j != i)[:k]
        out += [(i, n, j, -score) for n, (score, j) in enumerate(best, 1)]
    return sorted(out)


def products(spark, rows, **kinds):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns(
        {c: F.lit("?") for c in ("id", "v", "length")})
    whole = inner_products.whole_vectors(df, "vec_id", "embedding")
    return sorted(map(tuple, inner_products.top_products(
        whole, F.col("id") % 50 == 0, **kinds).collect()))


SMALL = dict(pack_rows=16, block_rows=16, blocks=3, seed_rows=40, basis_rows=100)


def some_vectors(n, dim, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)) * np.exp(-np.arange(dim) / 3) * rng.lognormal(0, 1, (n, 1))
    return [(i, v) for i, v in enumerate(x.tolist())]


@pytest.mark.parametrize("sizes", [{}, SMALL])
def test_products_against_brute_force(spark, sizes):
    rows = some_vectors(1500, 12)
    same = rows[50][1]
    rows += [(2000 + i, same) for i in range(300)]  # copies, queries among them
    rows += [(3000, [0.0] * 12), (3001, [-1e-9] * 12), (3050, [-5.0] * 12), (3050, [4.0] * 12),
             (3100, [1.0, 2.0]), (3101, []), (3150, []), (-50, [1.0] * 20), (4000, None),
             (4050, [None] * 12), (4100, [math.nan] * 12), (4150, [math.inf] * 12), (None, same)]
    assert products(spark, rows, **sizes) == brute_products(rows)


def test_products_beyond_doubles_and_few_rows(spark):
    rng = np.random.default_rng(1)
    large = [(i, v) for i, v in enumerate((rng.normal(size=(300, 6)) * 2e6).tolist())]
    assert products(spark, large, **SMALL) == brute_products(large)  # products above 2**53
    few = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (50, [-1.0, 0.0])]
    assert products(spark, few) == brute_products(few)
    assert products(spark, few[1:2]) == products(spark, few[:0]) == []
    with pytest.raises(ValueError):
        products(spark, [(0, [1e300]), (1, [1.0])])


def test_bounds_leave_out_most_products():
    x = np.floor(256 * np.array([v for _, v in some_vectors(4000, 24, 2)])).astype(np.int64)
    basis = inner_products.fit_basis(x.astype(float), True)
    side = inner_products._side(np.arange(len(x)), x, basis)
    asked = side.part(np.arange(0, len(x), 50))
    best = inner_products.Best(np.full(len(asked.ids), inner_products._NONE), 5)
    done = []
    add = best.add
    best.add = lambda at, ids, score: (done.append(len(at)), add(at, ids, score))
    inner_products.search_side(asked, side, best, 256)
    assert sum(done) < 0.1 * len(asked.ids) * len(x)
    full = asked.x @ side.x.T
    full[np.arange(len(asked.ids)), asked.ids] = -np.inf
    assert (best.score == -np.sort(-full, axis=1)[:, :5]).all()
