"""Joins, search, pages and archives against plain versions."""

from __future__ import annotations

import base64
import gzip
import hashlib
import math
import random
import time
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from samples import FOLDER, ODD
from plain import article, linked, top_k
from pyspark.sql import functions as F

from obsmart.llm import html_wrapper, ngram_join, page_tree, topk_search, warc
from obsmart.session import fresh_dir


# --- n-gram join ---------------------------------------------------------------
@pytest.fixture(params=["whole", "small parts"])
def parts(request, monkeypatch):
    """Tiles, leaves and chunks so small that every path is taken."""
    if request.param == "small parts":
        for name, value in {"TILE": 12, "LEAF": 3, "FAN": 2, "CHUNK": 2, "NEAR": 4, "BROADCAST_ROWS": 0}.items():
            monkeypatch.setattr(ngram_join, name, value)


def _near(spark):
    """Groups of near copies around the limit, and exact copies."""
    draw = random.Random(3)
    rows = []
    for group in range(6):
        base = [f"g{group}w{draw.randrange(400)}" for _ in range(40 + 30 * group)]
        for _ in range(14):
            text = list(base)
            for _ in range(draw.choice([0, 0, 1, 1, 2, 3])):
                text[draw.randrange(len(text))] = f"x{draw.randrange(10**6)}"
            rows.append((len(rows), " ".join(text)))
    return rows


@pytest.mark.parametrize("words, least", [(4, 85), (5, 80)])
def test_links_and_components_equal_brute_force(spark, parts, words, least):
    rows = _near(spark) + [(i + 1000, t) for i, t in [(0, ""), (1, None), (2, "a b"), (3, "A b"), (4, "a"), (5, "a  b\n")]]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string"), words, least).collect()}
    want = linked(rows, words, least)
    assert got == want and sum(v[2] for v in want.values()) > 100


def test_given_documents_equal_brute_force(spark, docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in ngram_join.op5_signature_tree_join(spark, FOLDER).collect()}
    assert got == linked(rows, 4, 85)


def test_odd_and_no_rows(odd, none):
    rows = ngram_join.join(odd).collect()
    assert len(rows) == len(ODD)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[5].component_id == by_id[6].component_id == 5 and by_id[8].component_id == by_id[9].component_id == 8
    assert all(by_id[i].component_id == i and by_id[i].n_shingles == 0 for i in (1, 2, 3))
    assert ngram_join.join(none).count() == 0


def test_one_row_of_each_group_stays_with_its_columns(spark, odd, none):
    kept = ngram_join.representatives(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [-12, 0, 1, 2, 3, 4, 5, 8, 10, 11]
    assert ngram_join.representatives(none).count() == 0
    rows = _near(spark)
    kept = ngram_join.representatives(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, v in linked(rows, 5, 80).items() if v[1] == i)


def test_one_row_of_each_group_stays_whatever_its_ids(spark):
    draw = random.Random(11)
    a, b, c, d = (" ".join(f"{g}{draw.randrange(10**6)}" for _ in range(40)) for g in "abcd")
    rows = [(3, a), (5, a), (5, b), (7, b), (None, c), (None, c), (None, c + " tail"), (None, d), (9, d), (11, "x y z"), (11, "p q r"), (12, ""), (12, None),
            (13, "one two three"), (13, "one two three")]
    kept = ngram_join.representatives(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80).collect()
    got = sorted(((r.doc_id or 0, r.text or "") for r in kept))
    null = [t for i, t in got if i == 0]
    assert len(null) == 1 and null[0] in (c, c + " tail")
    assert [x for x in got if x[0]] == [(3, a), (5, b), (9, d), (11, "p q r"), (11, "x y z"), (12, ""), (12, ""), (13, "one two three")]


def _staged(monkeypatch):
    """The columns of what a join stores, by label, and the rows that it deals to tiles."""
    seen, stage, pairs = {}, ngram_join.stage, ngram_join._pairs

    def noted(df, label):
        seen[label] = df.columns
        return stage(df, label)

    def counted(tiles, least, parts):
        seen["rows in tiles"] = tiles.count()
        return pairs(tiles, least, parts)

    monkeypatch.setattr(ngram_join, "stage", noted)
    monkeypatch.setattr(ngram_join, "_pairs", counted)
    return seen


def test_near_copies_meet_once_however_many_shingles_they_share(spark, monkeypatch):
    seen, draw, rows = _staged(monkeypatch), random.Random(17), []
    for pair in range(30):
        words = [f"p{pair}w{draw.randrange(10**6)}" for _ in range(300)]
        rows += [(2 * pair, " ".join(words)), (2 * pair + 1, " ".join([*words[:150], "other", *words[151:]]))]
    got = {r.doc_id: r.component_id for r in ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i - i % 2 for i in range(60)}
    assert seen["rows in tiles"] == 60  # not 60 for each of the 40 shingles or so that a pair shares


def test_sets_are_not_stored(spark, monkeypatch):
    seen = _staged(monkeypatch)
    ngram_join.join(spark.createDataFrame(_near(spark), "doc_id long, text string")).collect()
    assert "join-candidates" in seen and not [label for label, columns in seen.items() if label.startswith("join-") and "numbers" in columns]


def test_bytes_that_cross_come_back():
    draw = np.random.default_rng(5)
    rows = np.zeros(500, ngram_join.ENTRY)
    rows["token"], rows["a"], rows["n"] = draw.integers(0, 2**40, 500), draw.integers(0, 2**63, 500), draw.integers(1, 200_000, 500)
    rows["cells"] = np.minimum(draw.poisson(rows["n"][:, None] / ngram_join.CELLS, (500, ngram_join.CELLS)), 255)
    assert (ngram_join.expanded(ngram_join.squeezed(rows), ngram_join.ENTRY) == rows).all()
    for kind in ("<u4", "u1"):
        piece = draw.integers(0, 256, 1 << 12).astype(kind)
        data = ngram_join.piece_bytes(piece)
        assert (ngram_join.piece_numbers(data, kind) == piece).all() and len(data) < 1.1 * len(piece)


def test_a_filter_lets_all_its_ids_and_nulls_through(spark):
    ids = [None, 0, -1, 7, -(2**63), 2**63 - 1, *range(1000, 3000, 3)]
    known, bits = ngram_join._known(spark, spark.createDataFrame([(i,) for i in ids], "id long"))
    assert ngram_join.in_filter(pa.array(ids, pa.int64()), known.value, bits).all()
    assert ngram_join.in_filter(pa.array(range(10**6, 10**6 + 1000), pa.int64()), known.value, bits).sum() < 10


# --- top-k search ------------------------------------------------------------------
def test_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "GROUP_QUERIES", 2)
    monkeypatch.setattr(topk_search, "CHUNK", 40)
    draw = random.Random(5)
    centres = [[draw.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, [draw.choice(centres)[k] + draw.gauss(0, 0.05) for k in range(6)]) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(300, 360)]  # one common vector
    got = topk_search.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0)

    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    assert sorted(map(tuple, got.collect())) == top_k(whole, 5, 50)


def plain_top(rows, every=50, k=5):
    """Exact, with integers of any size, scores held within a long."""
    fine = [(i, [math.floor(Fraction(x) * 256) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, own in fine:
        if q % every == 0:
            scored = [(-max(1 - 2**63, min(2**63 - 1, sum(a * b for a, b in zip(own, x, strict=False)))), i) for i, x in fine if i != q]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, []), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [0.5]),
            (7, [1.0, 1.0]), (7, [1.0, 1.0]), (None, [9.0, 9.0]), (50, [1e300, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({n: F.lit(1) for n in ("grp", "wide", "score")})
    got = sorted(map(tuple, topk_search.top_k(frame, F.col("vec_id") % 50 == 0).collect()))
    most = 2**63 - 1
    assert got == [(0, 1, 50, most), (0, 2, 7, 256 * 256 * 3), (0, 3, 6, 256 * 128), (50, 1, 0, most), (50, 2, 6, most), (50, 3, 7, most)]
    assert topk_search.top_k(frame.where("false"), F.col("vec_id") % 50 == 0).count() == 0


def test_large_finite_vectors_are_found(spark):
    rng = np.random.default_rng(4)
    rows = [(0, [1.0, 1.0]), (1, [5e6, 1.0]), (2, [2.0, 1.0])]
    rows += [(i, [float(x) for x in rng.normal(0, 10.0 ** rng.integers(-2, 20), 2)]) for i in range(100, 400)]
    rows += [(400, [-1e308, 1e308]), (401, [5e-324, -5e-324]), (450, [0.0] * 1500), (451, [3e5] * 1500)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, topk_search.top_k(frame, F.col("vec_id") % 50 == 0).collect()))
    assert got == plain_top(rows) and topk_search.top_k(frame.where("vec_id < 3"), F.col("vec_id") == 0).first().vec_id == 1


def test_negative_bounds_and_a_vector_many_share(spark):
    rows = [(i, [-40.0, 40.0] if i % 2 else [40.0 + i % 3, -40.0]) for i in range(0, 400)]
    rows += [(1000 + i, [-30.0, 30.0]) for i in range(200)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for chosen in (rows, [r for r in rows if r[0] % 2 == 0 and r[0] < 400 and r[0] % 50 == 0] + rows[400:]):
        some = frame.where(F.col("vec_id").isin([r[0] for r in chosen]))
        assert sorted(map(tuple, topk_search.top_k(some, F.col("vec_id") % 50 == 0).collect())) == plain_top(chosen)
    upper = np.array([-5000.0, 5000.0, 0.0])
    assert (topk_search.above(upper) > upper).all()


# --- pages ---------------------------------------------------------------------------
def test_given_pages_equal_their_articles(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    want = {r.page_id: article(r.html) for r in pages.collect()}
    rows = html_wrapper.op4_wrapper_extraction(spark, FOLDER).collect()
    assert {r.page_id: r.text for r in rows} == want and all(r.n_chars == len(r.text) for r in rows)


def test_wrapper_tells_template_from_content(spark):
    def page(i):
        return (
            f"<html><body><div class=top>Welcome to the site</div><div class=x1><h2>Title {i}</h2><p>Body {i} &lt;one&gt;<p>more {i}</div>"
            f"<div class=x2>All rights reserved</div><ul class=x3><li><a href=/a{i}>link {i}</a><li><a href=/b>other {i}</a></ul></body>"
        )

    rows = [(i, f"http://h.example/{i}", page(i)) for i in range(8)] + [(90, "http://other.example/", "<p>alone</p>"), (91, None, None), (92, "x", "")]
    rows += [(100 + i, f"https://copy.example/{i}", "<p>the same</p>") for i in range(6)]
    got = {r.page_id: r.text for r in html_wrapper.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Title {i}\nBody {i} <one>\nmore {i}" for i in range(8))
    assert got[90] == "alone" and got[91] == got[92] == "" and {got[100 + i] for i in range(6)} == {"the same"}
    assert html_wrapper.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_wrapper_alone_finds_the_articles_of_given_pages(spark):
    """Without article elements, and without the lists of tags and classes."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    plain = pages.withColumn("html", F.regexp_replace("html", "<(/?)(?:article|main|nav|footer)>", "<$1div>"))
    want = {r.page_id: article(r.html) for r in pages.collect()}
    got = {r.page_id: r.text for r in html_wrapper.extract(plain, lists=False).collect()}
    assert got == want
    none = html_wrapper.wrappers(plain, lists=False).select(
        "host", F.lit(None).cast("string").alias("wrapper"), F.lit(None).cast("array<struct<node:int,hash:bigint>>").alias("template"),
        F.lit(None).cast("array<int>").alias("content"),
    )
    without = {r.page_id: r.text for r in html_wrapper.extract(plain, none, lists=False).collect()}
    assert sum(without[i] != text for i, text in want.items()) > 2000


def test_class_words_in_an_article(spark):
    kept = ["<div class='share-price'>a</div>", "<div class='ad-hoc'>b</div>", "<h2 class='header'>c</h2>", "<p class='notice-period'>d</p>"]
    kept += ["<div class='promotion-article'>e</div>", "<div class='comment-on-policy'>f</div>"]
    lost = ["<div class='ad'>x</div>", "<div class='cookie-notice'>x</div>", "<ol class='reader-comments'><li>x</ol>", "<div id='article-footer'>x</div>"]
    lost += ["<div class='related-articles'>x</div>", "<div class='big ad-slot'>x</div>"]
    rows = [(1, "http://a.example/", f"<article>{''.join(kept + lost)}</article>"), (1, "http://a.example/", f"<article>{''.join(kept + lost)}</article>")]
    pages = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "page_id long, url string, html string, host string, wrapper int, content int")
    assert [r.text for r in html_wrapper.extract(pages).collect()] == ["a\nb\nc\nd\ne\nf"] * 2


def test_matching_is_largest_and_long_pages_take_bounded_work():
    rng = random.Random(7)

    def shape(depth):
        return (rng.choice("abc"), tuple(shape(depth - 1) for _ in range(rng.randrange(5))) if depth else ())

    def plain(a, b):
        if a[0] != b[0]:
            return 0
        best = {}
        for i in range(len(a[1]) + 1):
            for j in range(len(b[1]) + 1):
                best[i, j] = max(best[i - 1, j], best[i, j - 1], best[i - 1, j - 1] + plain(a[1][i - 1], b[1][j - 1])) if i and j else 0
        return 1 + best[len(a[1]), len(b[1])]

    for _ in range(300):
        a, b = ("r", (shape(3), shape(2))), ("r", (shape(3), shape(2)))
        found = page_tree.matched(a, b)
        assert len(found) == page_tree.likeness(a, b) == plain(a, b)
        assert sorted(found.values()) == [found[i] for i in sorted(found)]
    names = [f"n{rng.randrange(10**9)}" for _ in range(20_000)]
    one = ("r", tuple((n, (("#", ()),)) for n in names))
    two = ("r", tuple((n if i % 3 else "q", (("#", ()),)) for i, n in enumerate(names)))
    begin = time.process_time()
    found = page_tree.matched(one, two)
    assert time.process_time() - begin < 20 and len(found) >= 2 * sum(1 for i in range(20_000) if i % 3)
    page = "".join(f"<div class=k{''.join(rng.choices('abcdef', k=9))}>text {i}</div>" for i in range(20_000))
    shape_, blocks = page_tree.shaped(page_tree.tree(page))
    assert len(blocks) == 20_000 and len(page_tree.matched(shape_, shape_)) == page_tree.size(shape_)


def test_copies_and_shared_titles_take_no_text_from_other_pages(spark):
    def page(i, title, tail=""):
        return f"<html><body><div class=top>Welcome</div><div class=x1><h1>{title}</h1><p>Body {i}</div>{tail}</body>"

    def article(i, title):
        return f"<html><body><main><h1>{title}</h1><p>Body {i}</main></body>"

    rows = [(i, "http://copies.example/", page("copied", "Home")) for i in range(85)]
    rows += [(i, f"http://copies.example/{i}", page(i, f"Title {i}", f"<table><tr><td>cell {i}</td></tr></table>")) for i in range(85, 100)]
    rows += [(200 + i, f"http://titles.example/{i}", page(i, "Same" if i < 85 else f"Own {i}")) for i in range(100)]
    rows += [(400 + i, f"http://main.example/{i}", article(i, "Same")) for i in range(20)]
    got = {r.page_id: r.text for r in html_wrapper.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == "Home\nBody copied" for i in range(85))
    assert all(got[i] == f"Title {i}\nBody {i}\ncell {i}" for i in range(85, 100))
    assert all(got[200 + i] == (f"Body {i}" if i < 85 else f"Own {i}\nBody {i}") for i in range(100))
    assert all(got[400 + i] == f"Same\nBody {i}" for i in range(20))


def test_dropped_elements_and_broken_markup():
    def texts(page):
        return [b[1] for b in page_tree.shaped(page_tree.tree(page))[1]]

    assert texts('<body class="has-sidebar"><form>f<article>yes<div class="comments"><article>no</article></div></article></form>') == ["yes"]
    assert texts("<nav>n</nav><p>a<p>b<b>c<br>d</p><script>if(1<2)'</p>'</script><!-- x --><footer>f</footer><p>cut &am") == ["a", "bc d", "cut &am"]
    assert texts("<div>" * 400 + "deep") == ["deep"] and texts("<p") == [] and texts("1 < 2") == ["1 < 2"]


def test_simple_tree_matching():
    a = ("r", (("x", ()), ("y", (("z", ()),)), ("w", ())))
    b = ("r", (("y", (("z", ()), ("q", ()))), ("w", ()), ("x", ())))
    assert page_tree.likeness(a, b) == 4 and page_tree.matched(a, b) == {0: 0, 2: 1, 3: 2, 4: 4}
    assert page_tree.likeness(a, ("other", ())) == 0 and page_tree.matched(a, ("other", ())) == {}


# --- archives --------------------------------------------------------------------------
def test_archives_give_back_every_page(spark):
    rows = [(1, "http://a/", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "http://b/ c\r\nd", None), (4, "http://d/", ""), (5, "http://e/", "é" * 5000),
            (5, "http://e/", "é" * 5000), (None, "http://f/", "<p>x</p>"), (6, "u", "\r\n\r\nWARC/1.1")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = fresh_dir(spark, "warc-test")
    index = warc.write(pages, folder, file_bytes=300)
    got = {r.page_id: r for r in warc.read(index, folder).collect()}
    assert index.count() == len(rows) and index.select("path").distinct().count() > 2
    digest = {i: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode() for i, _, t in rows}
    assert all(got[i].payload_digest == digest[i] and got[i].payload_bytes == len((t or "").encode()) for i, _, t in rows)
    assert {i: (r.record_type, r.refers_to) for i, r in got.items()} == {
        1: ("revisit", 2), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None), 5: ("response", None),
        None: ("revisit", 2), 6: ("response", None),
    }
    assert bytes(got[5].payload).decode() == "é" * 5000 and got[1].payload is None and bytes(got[6].payload) == b"\r\n\r\nWARC/1.1"
    some = warc.read(index.where("page_id = 5"), folder)
    assert some.count() == 2
    none = fresh_dir(spark, "warc-none")
    assert warc.read(warc.write(pages.where("false"), none), none).count() == 0


def test_a_damaged_record_is_refused():
    member = warc.record(1, "http://a/", b"abc", warc.base32_sha1(b"abc"), None, False)
    assert warc.parse(member)[2] == b"abc"
    with pytest.raises(ValueError, match="damaged"):
        warc.parse(gzip.compress(gzip.decompress(member).replace(b"abc", b"abd")))


def test_long_lists_of_children_are_matched_in_full():
    draw = np.random.default_rng(7)
    leaves = [("p", ()), ("p", (("b", ()),)), ("h2", ()), ("ul", (("li", ()),))]
    one, two = ([leaves[i] for i in draw.integers(0, 4, n)] for n in (620, 540))
    row = [0] * (len(two) + 1)
    for x in one:  # the largest matching, cell by cell
        new = [0]
        for j, y in enumerate(two):
            new.append(max(row[j + 1], new[j], row[j] + page_tree.likeness(x, y)))
        row = new
    a, b = ("div", tuple(one)), ("div", tuple(two))
    assert page_tree.likeness(a, b) == len(page_tree.matched(a, b)) == row[-1] + 1
