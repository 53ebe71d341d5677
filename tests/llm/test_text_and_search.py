import itertools
import math
import random
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from popflow.llm import ann, near_dup, pieces, templates
from popflow.session import cut

WORDS = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in ("n", "r", "st", "l")]


def text_of(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edited(rng, text, k):
    words = text.split()
    for _ in range(k):
        words[rng.randrange(len(words))] = "changed" + str(rng.randrange(10 ** 6))
    return " ".join(words)


@pytest.fixture(scope="module")
def copies():
    rng = random.Random(2)
    base = [text_of(rng, rng.randrange(60, 160)) for _ in range(60)]
    texts = list(base)
    for t in base[:12]:
        texts += [t, edited(rng, t, 1), edited(rng, t, 2)]
    for _ in range(40):  # a large group around one text
        texts.append(edited(rng, base[0], 1))
    texts += ["", "", None, "a b", "a b", "a c", " \n", text_of(rng, 30_000)]
    return [(None if i == 7 else i, t, "x") for i, t in enumerate(texts)] + [(3, base[3], "x")]


def brute_classes(rows, least=0.8):
    texts = [t or "" for _, t, _ in rows]
    sets = near_dup.shingles([t.encode() for t in texts])
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if texts[i] == texts[j] or near_dup.jaccard(sets[i], sets[j]) >= least:
            up[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(rows))]


@pytest.mark.parametrize("block_nodes", [512, 8])
def test_near_duplicates_against_all_pairs(spark, copies, block_nodes):
    df = spark.createDataFrame(
        [(*r, i) for i, r in enumerate(copies)], "doc_id long, text string, class_id string, n int")
    classes = cut(near_dup.near_duplicates(df, block_nodes=block_nodes))
    got = near_dup.with_class(df, classes).toPandas().sort_values("n")
    want = pd.Series(brute_classes(copies))
    lowest = pd.Series([r[0] for r in copies]).groupby(want).transform("min")
    assert (got["class_id"].to_numpy() == lowest.to_numpy()).all()
    assert (got["class_rows"].to_numpy() == want.groupby(want).transform("size").to_numpy()).all()
    kept = near_dup.keep_one(df, classes)
    assert kept.columns == df.columns and kept.count() == want.nunique()


def test_one_bridging_pair_in_a_large_bucket(spark, monkeypatch):
    # All texts share every band; only one pair is alike, so a deal mostly keeps it apart.
    monkeypatch.setattr(near_dup, "band_keys", lambda texts, bands, rows: np.ones(
        (len(texts), bands), np.uint64))
    rng = random.Random(6)
    texts = [text_of(rng, 60) for _ in range(100)]
    texts.append(edited(rng, texts[0], 1))
    rows = [(i, t) for i, t in enumerate(texts)]
    # A class of more than half a block beside it, with a partner of one member only.
    chain = [text_of(rng, 80)]
    for _ in range(12):
        chain.append(edited(rng, chain[-1], 1))
    rows += [(200 + i, t) for i, t in enumerate(chain)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dup.with_class(df, near_dup.near_duplicates(df, block_nodes=4)).toPandas()
    got = got.sort_values("doc_id")
    want = [rows[k][0] for k in brute_classes([(*r, None) for r in rows])]
    assert got["class_id"].tolist() == want and want[100] == 0 and want[-1] == 200


def test_common_shingles_lose_their_weight(spark):
    rng = random.Random(4)
    passage = text_of(rng, 60)
    rows = [(i, passage + " " + text_of(rng, 8)) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    keys, idf = near_dup.common_shingles(df.select("text"), 80, 0.5, 10)
    assert len(keys) == 56 and (idf == 0).all()
    plain = near_dup.near_duplicates(df)  # too few documents for any to be common
    assert plain.agg(F.count_distinct("class_id")).first()[0] < 80
    weighed = near_dup.near_duplicates(df, least_df=10)
    assert weighed.agg(F.count_distinct("class_id")).first()[0] == 80


def brute_tfidf_classes(texts, least=0.8):
    """Smallest position of each text's class, with the document frequency of every shingle."""
    sets = near_dup.shingles([(t or "").encode() for t in texts])
    df = Counter(k for keys, _ in sets for k in keys.tolist())
    sets = [near_dup.tfidf(s, np.array([df[k] for k in s[0].tolist()], float), len(texts))
            for s in sets]
    up = list(range(len(texts)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        if (texts[i] or "") == (texts[j] or "") or near_dup.jaccard(sets[i], sets[j]) >= least:
            up[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(texts))]


@pytest.mark.parametrize("block_nodes", [512, 4])
def test_every_shingle_weighs_by_its_document_frequency(spark, monkeypatch, block_nodes):
    monkeypatch.setattr(near_dup, "SLICE_BYTES", 1 << 12)
    rng = random.Random(8)
    passage = text_of(rng, 60)
    # What 80 documents share is 56 of 64 shingles each, but tells none of them apart.
    texts = [passage + " " + text_of(rng, 8) for _ in range(80)]
    texts += [text_of(rng, rng.randrange(60, 160)) for _ in range(20)]
    texts += [edited(rng, t, 1) for t in texts[80:90] for _ in range(3)]
    texts += [texts[80], "", None, "a b", "a b", "word " * 300, "word " * 300 + "end"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = near_dup.with_class(df, near_dup.near_duplicates(
        df, idf="every", block_nodes=block_nodes)).toPandas().sort_values("doc_id")
    assert got["class_id"].tolist() == brute_tfidf_classes(texts)


def test_texts_without_partners_do_not_meet(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "band_keys", lambda texts, bands, rows: np.ones(
        (len(texts), bands), np.uint64))
    rng = random.Random(6)
    base = [text_of(rng, 90) for _ in range(60)]  # all that are signed share every band
    texts = base + [edited(rng, t, 1) for t in base[:6]]
    blocks = []
    verified = near_dup._verified
    monkeypatch.setattr(near_dup, "_verified", lambda placed, *a: (
        blocks.append(placed.select("node").distinct().count()), verified(placed, *a))[1])
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = near_dup.with_class(df, near_dup.near_duplicates(
        df, idf="every", block_nodes=4)).toPandas().sort_values("doc_id")
    assert got["class_id"].tolist() == [i % 60 for i in range(66)]
    assert len(blocks) > 1 and max(blocks) == 12


def test_near_duplicates_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_dup.near_duplicates(empty).count() == 0
    nulls = spark.createDataFrame([(None, None), (None, "")], "doc_id long, text string")
    classes = near_dup.near_duplicates(nulls)
    assert [tuple(r) for r in near_dup.with_class(nulls, classes).select(
        "class_id", "class_rows").collect()] == [(None, 2)] * 2
    assert near_dup.keep_one(nulls, classes).count() == 1


def test_consistent_samples_estimate_weighted_similarity():
    rng = np.random.default_rng(0)
    a = (np.sort(rng.integers(0, 1 << 62, 300).astype(np.uint64)), rng.uniform(0.2, 3, 300))
    b = (a[0], a[1] * rng.choice([1.0, 0.5, 2.0], 300, p=[0.6, 0.2, 0.2]))
    keys = near_dup.band_keys([a, b], 3000, 1)
    assert (keys[0] == keys[1]).mean() == pytest.approx(near_dup.jaccard(a, b), abs=0.03)


def brute_viterbi(word, vocabulary):
    """Best (score, ids) of a word by trying every cut."""
    table = {p: (s, [i]) for p, i, s in vocabulary.pieces}
    best = [(0.0, [])]
    for end in range(1, len(word) + 1):
        ways = []
        for start in range(end):
            part = word[start:end]
            if part in table:
                score, ids = table[part]
            elif len(part) == 1:
                score, ids = pieces.UNKNOWN, [vocabulary.byte_ids[b] for b in part.encode()]
            else:
                continue
            ways.append((best[start][0] + score, best[start][1] + ids))
        best.append(max(ways, key=lambda w: w[0]))
    return best[-1]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load(pieces.default_model())


def test_pieces_round_trip(spark, vocabulary, monkeypatch):
    texts = [None, "", " ", "a  b\n\n\tc▁d", "漢字😀 é́ ​", "x" * 300, "The end. 12,5 %%%",
             " lead", "trail ", "\n", "Straße naïve coöperate", "word " * 3000]
    df = spark.createDataFrame(
        [(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, pieces string")
    for n, known in ((250, 1 << 20), (2, 5)):  # also batches after a task has forgotten its words
        monkeypatch.setattr(pieces, "BATCH_TEXTS", n)
        monkeypatch.setattr(pieces, "KNOWN_BYTES", known)
        coded = cut(pieces.encode(df, vocabulary))
        back = pieces.decode(coded, vocabulary).toPandas().sort_values("doc_id")
        assert back["decoded"].tolist() == [t or "" for t in texts]
        assert [len(p) for p in back["pieces"][:2]] == [0, 0]
    assert pieces.encode(df.limit(0), vocabulary).count() == 0


def test_long_runs_are_one_word(spark, vocabulary):
    """Runs of letters, signs and blanks of some hundred characters, against Viterbi on whole runs."""
    rng = np.random.default_rng(4)
    runs = ["".join(rng.choice(list("aeinrstloché"), 700)), "=" * 300, "-=" * 200, " " * 301 + "end",
            "7" * 333, "x" * 5000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(runs)], "doc_id long, text string")
    score = {i: s for _, i, s in vocabulary.pieces}
    for r in pieces.encode(df, vocabulary).collect():
        if r.text[0] == " ":  # the last blank goes with the word, the blank added with the others
            words = [" " * 301, " end"]
        elif len(r.text) > pieces.LONGEST:
            words = [" " + r.text[:pieces.LONGEST], r.text[pieces.LONGEST:]]
        else:
            words = [" " + r.text]
        want = sum(brute_viterbi(w, vocabulary)[0] for w in words)
        known = [score[p] for p in r.pieces if p in score]
        lost = sum(c not in {p for p, _, _ in vocabulary.pieces} for c in r.text)
        assert sum(known) + pieces.UNKNOWN * lost == pytest.approx(want, rel=1e-4)
    blanks = {i for p, i, _ in vocabulary.pieces if p.strip(" ") == "" and len(p) > 1}
    assert blanks & set(pieces.encode(df, vocabulary).filter("doc_id = 3").first().pieces)


def test_decoding_ignores_foreign_ids(spark, vocabulary):
    ids = {p: i for p, i, _ in vocabulary.pieces}
    df = spark.createDataFrame([([ids[" a"], 10 ** 6, -1, ids["b"]],), ([],), (None,)], "pieces array<int>")
    assert [r.decoded for r in pieces.decode(df, vocabulary).collect()] == ["ab", "", ""]


def test_pieces_are_the_best_way(spark, vocabulary):
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcdeéßñ tion ing,.") for _ in range(30)) for _ in range(20)]
    texts += ["international", "▁x", "unbelievable tokenization"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    score = {i: s for _, i, s in vocabulary.pieces}
    split = df.withColumn("words", pieces.words_of(F.col("text")))
    for r in pieces.encode(split, vocabulary).collect():
        assert "".join(r.words) == " " + r.text
        want = sum(brute_viterbi(w, vocabulary)[0] for w in r.words)
        unknown = sum(1 for c in r.text if c not in {p for p, _, _ in vocabulary.pieces}
                      and c != " ")
        known = [score[p] for p in r.pieces if p in score]
        assert sum(known) + pieces.UNKNOWN * unknown == pytest.approx(want)
        assert math.isfinite(want)


def test_substrings_no_piece_begins_with_are_not_joined(vocabulary, monkeypatch):
    """The lattice holds every piece of every word, though few of the substrings are looked up."""
    words = ["xqzjkxqzjkvwxqzjk", " international", "", " ", "漢字😀é", " " * 20, "unbelievable", "a▁b"]
    names = [p for p, _, _ in vocabulary.pieces]
    costs = np.arange(len(names))
    looked_up = []
    look = pieces.pc.index_in

    def counted(values, **options):
        looked_up.append(len(values))
        return look(values, **options)

    prefixes = pieces.prefixes_of(names)
    with monkeypatch.context() as m:
        m.setattr(pieces.pc, "index_in", counted)
        pieces.lattice(pa.array(words[:1]), prefixes, costs)
    rows, longest = {p: i for i, p in enumerate(names)}, vocabulary.longest
    substrings = sum(min(longest, len(words[0]) - i) for i in range(len(words[0])))
    assert sum(looked_up) < substrings / 2
    got = pieces.lattice(pa.array(words), prefixes, costs).to_pylist()
    for word, ends in zip(words, got):
        want = []
        for end in range(1, len(word) + 1):
            parts = [word[start:end] for start in range(max(0, end - longest), end)]
            ways = {(len(p), costs[rows[p]], rows[p]) for p in parts if p in rows}
            if parts[-1] not in rows:
                ways.add((1, pieces._UNKNOWN_COST, len(names) + ord(parts[-1])))
            want.append(ways)
        low = (1 << pieces._ROW_BITS) - 1
        assert [{((e >> pieces._ROW_BITS & pieces._LENGTHS - 1) + 1, e >> pieces._EDGE_BITS, e & low)
                 for e in edges} for edges in ends] == want
        assert [len(edges) for edges in ends] == [len(w) for w in want]


def test_words_are_looked_up_once_a_batch(spark, vocabulary, monkeypatch):
    """Also where a task forgets its words between Arrow batches, and the lattices take many rows."""
    texts = [f"word{i % 7} naïve  {'ab' * (i % 5)}\n{i}" if i % 11 else None for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    whole = {r.doc_id: r.pieces for r in pieces.encode(df, vocabulary).collect()}
    monkeypatch.setattr(pieces, "BATCH_WORDS", 9)
    monkeypatch.setattr(pieces, "LATTICE_CHARS", 8)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "4")
    try:
        for known in (0, 100, 1 << 20):
            monkeypatch.setattr(pieces, "KNOWN_BYTES", known)
            coded = pieces.decode(pieces.encode(df, vocabulary), vocabulary).collect()
            assert {r.doc_id: r.pieces for r in coded} == whole
            assert [r.decoded for r in coded] == [t or "" for t in texts]
    finally:
        spark.conf.set(name, before)


def page(body, head="<title>T</title><style>p{}</style><script>var a='</p>';</script>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


def test_article_without_its_surroundings():
    got = templates.main_texts([
        page("<nav><ul><li>Menu</li></ul></nav><!-- ad --><div class='ad'>Buy</div><article><h1>A"
             " &amp; B</h1><p><b>One\n two<br><p>Three &lt;x&gt;</p><aside>no</aside>"
             "<form>Mail <input></form><ul><li>i</li><li>ii</ul></article><footer>&copy;</footer>"),
        None, "", "just text", page("<main><p>In main</p><div id='comments'><p>No</p></div></main>"),
        page("<article><p>Text</p><section class='comment-list'><article><p>reader</p></article>"
             "</section></article>"),
        page("<header>Top</header><p>Body</p><div role=banner>x</div><div class=cookie>y</div>")[:-9],
        "<article><p>cut <b", "<article><p>a</p><script>while(1){}"])
    assert got == ["A & B\nOne two\nThree <x>\ni\nii", "", "", "just text", "In main", "Text", "Body",
                   "cut", "a"]


@pytest.mark.parametrize("between, text", [
    ('<svg width="1"/>', ""), ("<svg><title>t</title><text>x</text></svg>", ""),
    ("<button>Go", "Go"), ("<button class=b>Go</button>", ""), ("<select><option>1", "1"),
    ("<object data=x><p>fallback text</p></object>", "fallback text"),
    ("<p>let <math>x+1</math> be</p>", "let x+1 be"), ("<p>a <button>no</button> b</p>", "a b"),
    ('<a href="x>link</a>', "link"), ("<noscript>", ""), ("<template><p>no</p></template>", ""),
    ("<textarea>no <p> no</textarea>", ""), ("<script>if (a < b) '</p>'", None),
])
def test_odd_markup_loses_nothing_after_it(between, text):
    body = f"<article><p>one two three</p>{between}<p>four five six</p></article>"
    want = "\n".join(x for x in ("one two three", text, "four five six") if x)
    # An unclosed script holds the rest of the page, as in a browser.
    assert templates.main_texts([body]) == ["one two three" if text is None else want]


def test_names_of_wrappers_do_not_lose_the_page():
    article = "<article class='post social'><p>Text</p><article class='comment'>No</article></article>"
    for body in (f"<body class='has-sidebar'>{article}</body>",
                 f"<html class=nav><body id='search' class='menu-open'>{article}</body></html>",
                 f"<div class='content-with-sidebar'>{article}<div class='widget'>No</div></div>",
                 "<main class='modal'><p>Text</p><div class='x related_links'>No</div></main>",
                 "<div role=main class=banner><p>Text</p><ul class='ad-list'><li>No</ul></div>",
                 "<body class='sidebar'><p>Text</p><div class='share box'>No</div></body>"):
        assert templates.main_texts([body]) == ["Text"], body


def test_template_words_are_left_out_where_no_article_is_marked():
    pages = [page(f"<div><p>Story {i} of day {i * i}</p></div><div><p>Contact us any time</p></div>")
             for i in range(8)]
    assert templates.main_texts(pages) == [f"Story {i} of day {i * i}" for i in range(8)]
    # Too few pages for a template: nothing is dropped.
    assert templates.main_texts(pages[:2])[1] == "Story 1 of day 1\nContact us any time"


def test_equivalence_classes():
    pages = [["a", "x", "b", "w1"], ["a", "x", "x", "b", "w2"], ["a", "b", "x", "w1"]]
    found = templates.equivalence_classes(pages, 2)
    assert found["a"] == found["b"] == 0 and found["x"] > 0 and found["w1"] != found["x"]
    assert "w2" not in found


def test_slots_of_the_nested_template():
    # The same words in different slots are text; in one slot they are the template's.
    rain = "<p>Rain today</p>"
    pages = [page("<h1>Site</h1>" + (f"{rain}<h2>News</h2>" if i % 2 else f"<h2>News</h2>{rain}")
                  + f"<div>Text {i * i}</div>") for i in range(6)]
    pages += [page(f"<h1>Site</h1><h2>News</h2><div>Text {i * i}</div>") for i in (6, 7)]
    assert templates.main_texts(pages) == [
        "Rain today\n" * (i < 6) + f"Text {i * i}" for i in range(8)]
    # Equal pages count once, so copies are no template.
    assert templates.main_texts(pages[:3] + [pages[0]] * 9)[-1] == "Site\nNews\nRain today\nText 0"
    # A mark chooses among the slots and keeps what its articles share.
    marked = [page(f"<p>Out {i}</p><p>Top</p><article>One for all</article>") for i in range(8)]
    assert templates.main_texts(marked) == ["One for all"] * 8


def test_classes_are_nested_in_slots():
    pages = [["</b", "</b/i", "/b/i x", f"/b/i {i}", "</b/u", "/b/u y"][:6 - 2 * (i % 2)]
             for i in range(6)]
    found = templates.nested_template(pages, 3)
    assert found["</b"].parent is None and found["/b/i x"][:2] == (0, None)
    assert found["/b/u y"].number == found["</b/u"].number > 0
    assert found["/b/u y"][1:] == (0, 3)  # after the three tokens of the root
    # A token on the other side of its parent's tokens on some pages is text.
    moved = [["</b", "/b z", "</b/i", "w"] if i % 3 else ["</b", "</b/i", "/b z", "w"]
             for i in range(6)] + [["</b", "</b/i", "w"]]
    assert "/b z" not in templates.nested_template(moved, 3)


def test_pages_of_a_large_host_are_cut_into_groups(spark):
    rows = [(i, "http://h.example/x" if i % 3 else None, page(
        f"<div>Only {i}</div><div>Same on all</div>"), "c") for i in range(100)]
    rows += [(None, "http://H.example:80/", None, "c"), (5, "http://h.example/x", "", "c")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = templates.extract(df, group_pages=10)
    assert got.columns == ["page_id", "url", "text"]
    texts = {r.page_id: r.text for r in got.collect() if r.text}
    assert texts == {i: f"Only {i}" for i in range(100)} and got.count() == 102
    assert templates.extract(df.limit(0)).count() == 0


def test_every_page_of_a_host_loses_its_template(spark):
    def rows(host, n):
        return [(i, f"http://{host}/{i}", page(f"<div>Only {i}</div><div>Same on all</div>"))
                for i in range(n)]

    # A page over a host's full group, and pages of which few make a full group by their bytes.
    df = spark.createDataFrame(rows("a", 65) + rows("b", 66) + rows("c", 300) + rows("d", 67),
                               "page_id long, url string, html string")
    for spread, chars in ((1, 1 << 23), (40, 1 << 23), (3, 300)):
        got = templates.extract(df.repartition(spread), group_chars=chars).collect()
        assert len(got) == 498 and all(r.text == f"Only {r.page_id}" for r in got)


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(30, 16))
    x = (centres[rng.integers(0, 30, 3000)] + 0.3 * rng.normal(size=(3000, 16))).astype(np.float32)
    x[100:900] = x[100]  # copies fill a leaf
    rows = [(i, [float(v) for v in r], "c") for i, r in enumerate(x)]
    rows += [(5000, None, "c"), (5050, [0.0] * 16, "c"), (5100, [float("nan")] * 16, "c"),
             (5150, [0.0] * 3, "c"), (None, [1.0] * 16, "c"), (5200, [None] * 16, "c"),
             (5250, [float("inf")] * 16, "c"), (5300, [], "c")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    valid, dim = ann.valid_vectors(df, "vec_id", "embedding")
    assert dim == 16 and valid.count() == 3000
    is_query = F.col("id") % 50 == 0
    index = ann.build(valid, dim, is_query, leaf_rows=100)
    assert index.tree.leaves > 5 and 1 <= index.visits < index.tree.leaves
    got = ann.search(index, is_query, block_rows=64).toPandas()
    assert (got.groupby("query_id")["rank"].apply(sorted).map(tuple) == (1, 2, 3, 4, 5)).all()
    hits = 0
    for q, part in got.groupby("query_id"):
        score = ann.exact_cosines(np.tile(x[q].astype(float), (3000, 1)), x.astype(float))
        score[q] = -2
        order = np.lexsort((np.arange(3000), -score))[:5]
        part = part.sort_values("rank")
        hits += len(set(part["vec_id"]) & set(order))
        assert np.array_equal(part["score"], score[part["vec_id"]])
        if q == 150:  # a copy: ties go to the smallest ids
            assert part["vec_id"].tolist() == [100, 101, 102, 103, 104]
    assert len(got) == 60 * 5 and hits / len(got) >= 0.9


def test_fewer_candidates_than_neighbours(spark):
    df = spark.createDataFrame(
        [(0, [1.0, 0.0]), (50, [0.0, 2.0]), (50, [0.0, 2.0]), (7, [1.0, 1.0])],
        "vec_id long, embedding array<double>")
    is_query = F.col("id") % 50 == 0
    rows, dim = ann.valid_vectors(df, "vec_id", "embedding")
    got = ann.search(ann.build(rows, dim, is_query), is_query).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == [
        (0, 1, 7), (0, 2, 50), (0, 3, 50), (50, 1, 7), (50, 2, 0)]
    short = spark.createDataFrame(
        [(0, [1.0, 0.0, 0.0]), (1, [2.0]), (2, [1.0, 1.0]), (3, [0.0, 1.0, 1.0])],
        "vec_id long, embedding array<double>")
    rows, dim = ann.valid_vectors(short, "vec_id", "embedding")  # as if filled up with zeros
    assert [(r.vec_id, round(r.score, 6)) for r in ann.search(
        ann.build(rows, dim, is_query), is_query).orderBy("rank").collect()] == [
            (1, 1.0), (2, 0.707107), (3, 0.0)]
    large = np.array([[1e200, 2e200, 0.0], [3e-300, 4e-300, 0.0]])
    assert ann.exact_cosines(large, large).tolist() == pytest.approx([1.0, 1.0])
    none, dim = ann.valid_vectors(df.limit(0), "vec_id", "embedding")
    assert ann.search(ann.build(none, dim, is_query), is_query).count() == 0


def test_pipeline_stage_by_stage(spark, tmp_path):
    rng = random.Random(6)
    docs = [(i, " ".join(text_of(rng, 12).capitalize() + "." for _ in range(4)), "en",
             f"s{i % 2}" if i % 5 else None, 0) for i in range(120)]
    docs += [(200 + i, edited(rng, docs[i][1], 1), "en", "s0", 0) for i in range(10)]
    junk = [(300 + i, " ".join(w + "%%%" for w in text_of(rng, 50).split()), "en", "s1", 0)
            for i in range(25)]
    docs += junk + [(400, None, None, None, None), (401, "", "en", "s0", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1) for i in range(0, 60)], "doc_id long, quality int").write.parquet(
        str(tmp_path / "labels.parquet"))
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    state, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES:
        seen[name] = state = cut(stage(spark, state, str(tmp_path)))
    ids = {n: {r.doc_id for r in df.select("doc_id").collect()} for n, df in seen.items()}
    clean = ids[names[0]] & set(range(120))
    assert len(clean) >= 110 and not ids[names[0]] & set(range(300, 325))
    assert ids[names[1]] >= clean and 401 not in ids[names[1]]
    both = {i for i in range(10) if {i, 200 + i} <= ids[names[1]]}
    assert len(ids[names[2]]) == len(ids[names[1]]) - len(both)
    for name in names[:4]:
        assert seen[name].columns == schema.replace(" long", "").replace(" string", "").split(", ")
    last = seen[names[4]]
    assert last.count() == seen[names[3]].count() and last.filter("NOT round_trip").isEmpty()
    empty = spark.createDataFrame([], schema)
    for _, stage in corpus_pipeline.STAGES:
        empty = cut(stage(spark, empty, str(tmp_path)))
    assert empty.count() == 0


def test_stages_take_odd_rows(spark, tmp_path):
    """Nulls, repeated rows, a very long text and columns named like those the stages add."""
    rng = random.Random(9)
    text = " ".join(text_of(rng, 12).capitalize() + "." for _ in range(20))
    rows = [(i, " ".join(text_of(rng, 12).capitalize() + "." for _ in range(4)), "s", i, "x")
            for i in range(30)]
    rows += [(None, text, None, 1, None), (7, None, "s", 2, "y"), (7, "", "s", 2, "y"),
             (40, "word " * 60_000, "t", 3, "z"), (41, text, "t", 4, "z"), (41, text, "t", 4, "z")]
    names = "doc_id long, text string, source string, __size int, copies string"
    docs = spark.createDataFrame(rows, names).withColumns(
        {c: F.lit("?") for c in ("lang", "node", "__copy", "size", "doc", "target", "broken_rule")})
    spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(30)],
                          "doc_id long, quality int, toxic int").write.parquet(
                              str(tmp_path / "labels.parquet"))
    for name, stage in corpus_pipeline.STAGES[:4]:
        got = cut(stage(spark, docs, str(tmp_path)))
        assert got.columns == docs.columns, name
        assert got.exceptAll(docs).isEmpty() or name == corpus_pipeline.STAGES[3][0], name
        assert got.select(docs.columns).subtract(docs).isEmpty(), name
    kept = corpus_pipeline.near_dup_stage(spark, docs, str(tmp_path))
    assert kept.filter(F.col("text") == text).count() == 1
    assert kept.filter(F.coalesce("text", F.lit("")) == "").count() == 1
    last = corpus_pipeline.pieces_stage(spark, docs, str(tmp_path))
    assert last.count() == len(rows) and last.filter("NOT round_trip").isEmpty()


def test_few_links_are_followed_in_one_task(spark, monkeypatch):
    rng = np.random.default_rng(5)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [
        (i, i + 1) for i in range(1000, 1060)]
    edges = spark.createDataFrame([(bytes([a >> 8, a & 255]), bytes([b >> 8, b & 255]))
                                   for a, b in pairs], "a binary, b binary")
    written = []
    monkeypatch.setattr(near_dup, "cut", lambda df: written.append(1) or cut(df))
    got = {tuple(map(bytes, r)) for r in near_dup.components(edges).collect()}
    assert len(written) == 1
    assert got == {tuple(map(bytes, r)) for r in near_dup.components(edges, few=0).collect()}
    assert len(written) > 3
    assert near_dup.components(edges.limit(0)).count() == 0


def test_buckets_are_dealt_again_only_while_classes_grow(spark, monkeypatch):
    # One text with its ending changed: all are candidates, and few pairs are similar enough. No
    # gain is enough here, so that the meetings have to find what one deal leaves.
    monkeypatch.setattr(near_dup, "LEAST_GAIN", 2.0)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(words + [f"x{i}a{j}" for j in range(9)]) for i in range(240)]
    texts += [f"{t} y" for t in texts[:60]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    turns, dealt = [], near_dup._dealt
    monkeypatch.setattr(near_dup, "_dealt", lambda rows, turn: turns.append(turn) or dealt(rows, turn))
    kept = near_dup.near_duplicates(df, block_nodes=16).toPandas()
    assert turns == [0, 1]
    sets = [(k, n.astype(float)) for k, n in near_dup.shingles([t.encode() for t in texts])]
    alike = [(i, j) for i in range(len(texts)) for j in range(i)
             if near_dup.jaccard(sets[i], sets[j]) >= 0.8]
    assert alike == [(240 + i, i) for i in range(60)]
    assert sorted(kept["class_rows"]) == [1] * 180 + [2] * 120


def test_queries_meet_leaves_in_blocks(spark):
    """A visit is not a row: what is held and moved at once is a block, whatever the visits."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(3000, 6))
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)],
                               "id long, v array<double>").repartition(3)
    is_query = F.col("id") % 10 == 0
    index = ann.build(df, 6, is_query, leaf_rows=20)
    blocks = ann.query_blocks(index, is_query, 5, 64).collect()
    assert len(blocks) <= (300 // 64 + 1) * ann._parts(index, 64).sum() * 2
    seen = set()
    for b in blocks:
        ids = np.frombuffer(b.q_ids, np.int64)
        assert len(ids) <= 64 and (np.frombuffer(b.q).reshape(-1, 6) == x[ids]).all()
        assert not seen & {(b.leaf, b.part, i) for i in ids}
        seen |= {(b.leaf, b.part, i) for i in ids}
    q = ann.unit(x[::10])
    assert seen == {(leaf, p, 10 * i) for i, v in enumerate(q) for leaf in ann.visits(
        index.tree, v, index.sizes, index.visits, 6) for p in range(ann._parts(index, 64)[leaf])}
