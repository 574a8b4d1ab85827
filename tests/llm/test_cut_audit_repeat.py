"""Fill-in-middle, substring dedup and the filter audit against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from plain import words
from pyspark.sql import functions as F
from samples import DOC, LONG, ODD

from obsmart.llm import common, fill_middle, filter_audit, repeated_spans
from obsmart.llm.common import stage

LABEL = "doc_id long, quality int, toxic int"


def buffers(column):
    column = common.texts(pa.array(column, pa.large_string())).cast(pa.large_binary())
    start = np.frombuffer(column.buffers()[1], np.int64)[: len(column) + 1]
    return np.frombuffer(column.buffers()[2] or b"", np.uint8)[: start[-1]], start


# --- fill in middle ------------------------------------------------------------
def plain_middle(doc_id, text, rate=100, suffix_first=50):
    """(n, form, prefix_chars, middle_chars, output)"""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < suffix_first:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def lined(rnd, size):
    return "".join(rnd.choices(["\n", "a", "é", "😀", "<", "S>", "\r\n", "long word "], k=size))


def test_forms_and_parts_equal_the_plain_ones(spark, odd, docs):
    rnd = random.Random(5)
    made = [(i, lined(rnd, rnd.choice([0, 1, 5, 300, 9000])), None, None, 0) for i in range(150)]
    made += [(200, "a<P>b\n", None, None, 0), (201, "\n" * 9000, None, None, 0), (202, "x" * 9000, None, None, 0), (203, "ends <\n", None, None, 0)]
    for df in (odd, docs, spark.createDataFrame(made, DOC)):
        for options in ({}, {"rate": 40, "suffix_first": 10}):
            found = fill_middle.transform(df, **options)
            rows = found.withColumn("back", fill_middle.restored(F.col("form"), F.col("output"))).collect()
            texts = Counter((r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect())
            assert Counter((r.doc_id, r.back) for r in rows) == texts
            for r in rows:
                assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_middle(r.doc_id, r.back, **options)


def test_descent_finds_every_cut():
    rnd = random.Random(6)
    texts = [lined(rnd, k) for k in (0, 1, 7, 40, 1000, 3000)]
    data, start = buffers(texts)
    for block in (1, 3, 16, 2048):
        trees = fill_middle.BlockTrees.build(data, start, block)
        for i, text in enumerate(texts):
            units = re.findall(r"[^\n]*\n|[^\n]+", text)
            ks = np.arange(len(units) + 1)
            at, points = trees.cuts(np.full(len(ks), i), ks, block)
            for k in ks:
                begun = "".join(units[:k])
                assert (at[k], points[k]) == (len(begun.encode()), len(begun))


def test_no_documents_no_outputs(none):
    assert fill_middle.transform(none).count() == 0


# --- repeated spans ----------------------------------------------------------------
def plain_rest(rows, window):
    """Multiset of (doc_id, words, words left) after repeated windows are gone."""
    found = [words(t) for _, t in rows]
    often = Counter(tuple(w[i : i + window]) for w in found for i in range(len(w) - window + 1))
    out = Counter()
    for (doc_id, _), w in zip(rows, found, strict=True):
        gone = {i + k for i in range(len(w) - window + 1) if often[tuple(w[i : i + window])] > 1 for k in range(window)}
        out[doc_id, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)] += 1
    return out


def got_rest(df, *args):
    return Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in repeated_spans.dedup(df, *args).collect())


def test_rest_equals_the_plain_one(spark, odd, docs):
    for df in (odd, docs):
        rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        assert got_rest(df) == plain_rest(rows, 35)


@pytest.mark.parametrize(("window", "anchor"), [(5, 2), (8, 8), (6, 1)])
def test_branches_loops_and_short_alphabets(spark, window, anchor):
    rnd = random.Random(window)
    rows = [(i, " ".join(rnd.choices("ab", k=rnd.choice([3, 9, 30, 60]))), None, None, 0) for i in range(60)]
    rows += [(100, "a " * 300, None, None, 0), (101, " \x1c x\x85y " + "p q r s t u v w " * 4, None, None, 0), (102, None, None, None, 0)]
    df = spark.createDataFrame(rows, DOC)
    assert got_rest(df, window, anchor) == plain_rest([(r[0], r[1]) for r in rows], window)


def test_stretches_change_nothing():
    rnd = random.Random(9)
    column = pa.array([" ".join(rnd.choices("abc", k=400)), "a b", "", " ".join(rnd.choices("abc", k=90))], pa.large_string())
    made = repeated_spans.Words(column)
    made.hash()
    for stretch in (1, 7, 64, 1 << 19):
        covered = [(int(t), int(s) + k) for p in repeated_spans.paths_of(made, 6, 3, stretch) for t, s, n in zip(p["text"], p["start"], p["n"], strict=True) for k in range(n)]
        assert sorted(covered) == [(t, s) for t, n in ((0, 400), (3, 90)) for s in range(n - 5)]


def test_heavy_keys_meet_all_their_rows(spark):
    left = stage(spark.range(30_000).select((F.col("id") % 7 * (F.col("id") % 2)).alias("k"), "id"), "met-left")
    right = stage(left.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("k < 6"), "met-right")
    got = common.met(left, right, ["k"], "n")
    assert got.count() == left.where("k < 6").count() == got.select("id").distinct().count()


def test_coordinates_are_verified(spark):
    rows = spark.createDataFrame([(0, "a b c d e f g h")], "row long, text string")
    wrong = rows.withColumn("paths", F.expr("array(struct(0 as start, 2 as n, 1L as c, 5L as h1, 6L as h2))"))
    with pytest.raises(Exception, match="PathDiffers"):
        repeated_spans._edges(wrong, 5).collect()


def test_a_planted_passage_goes_and_clean_texts_stay(spark):
    passage = " ".join(f"p{i}" for i in range(50))
    clean = [(i, " ".join(f"c{i}-{k}" for k in range(80)), None, None, 0) for i in range(30)]
    mixed = [(100 + i, f"head{i} {passage} tail{i}", None, None, 0) for i in range(40)]
    got = got_rest(spark.createDataFrame(clean + mixed, DOC))
    assert all(removed == (50 if doc_id >= 100 else 0) for doc_id, _, removed, _ in got)


def test_no_documents_no_spans(none):
    assert repeated_spans.dedup(none).count() == 0


# --- the audit -----------------------------------------------------------------------
def plain_audit(rows, labels):
    """part -> order -> list of the five steps' counts."""
    first = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    good, toxic = ({i for i, *q in labels if q[k] == 1 and i is not None} for k in (0, 1))
    judged = defaultdict(list)
    for doc_id, text, lang in rows:
        text = text or ""
        w = words(text)
        failing = [
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
            any(c in "#$%&*|" for c in text), doc_id is not None and doc_id > first[text],
        ]
        judged[lang or ""].append(({f for f, bad in zip("ABCDE", failing, strict=True) if bad}, doc_id in good, doc_id in toxic))
    out = {}
    for part, docs in judged.items():
        shapley = Counter()
        for order in permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                before = set(order[: step - 1])
                here = [d for d in docs if f in d[0] and not d[0] & before]
                shapley[f] += len(here)
                out[part, "".join(order), step] = [
                    sum(not d[0] & {*before, f} for d in docs), len(here), sum(f in d[0] and bool(d[0] & before) for d in docs),
                    sum(d[0] == {f} for d in docs), sum(d[1] for d in here), sum(d[2] for d in here),
                ]
        for key in out:
            if key[0] == part:
                out[key].append(shapley[key[1][key[2] - 1]])
    return out


def got_audit(df, labels):
    measures = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = filter_audit.audit(filter_audit.failure_counts(df, labels)).collect()
    assert len(rows) == len({(r.part, r.filter_order, r.step) for r in rows})
    return {(r.part, r.filter_order, r.step): [r[m] for m in measures] for r in rows}


def test_audit_equals_the_plain_one(spark, odd, docs):
    marks = [(i, i % 2, i % 3 == 0) for i in range(0, 200, 3)] + [(6, 1, 1), (6, 0, 0), (None, 1, 1), (8, None, 1), (10, 1, None)]
    marks = [(i, q, None if t is None else int(t)) for i, q, t in marks]
    copies = [(50, "same", "en", None, 0), (49, "same", None, None, 0), (49, "same", "en", None, 0), (None, "same", "en", None, 0), (51, "same", "", None, 0), (52, "", "fr", None, 0)]
    for df in (odd, docs, odd.drop("row").select(DOC.fieldNames()).union(spark.createDataFrame(copies, DOC))):
        rows = [(r.doc_id, r.text, r.lang) for r in df.select("doc_id", "text", "lang").collect()]
        want = plain_audit(rows, marks)
        assert len(want) == 600 * len({r[2] or "" for r in rows})
        assert got_audit(df, spark.createDataFrame(marks, LABEL)) == want


def test_one_pass_counts_every_byte():
    rnd = random.Random(3)
    texts = ["".join(rnd.choices(list("aAbB #$%&*|<\t\n\r\x0b\x0c\x85 é漢😀Z."), k=rnd.choice([0, 1, 3, 50, 400]))) for _ in range(300)]
    texts += ["", " ", LONG, "verylongword" * 30 + " " + "verylongword" * 30 + "s " + "verylongword" * 30, "Z"]
    found = filter_audit.scan(*buffers(texts))
    for i, t in enumerate(texts):
        w = words(t)
        want = (len(w), len(set(w)), sum("A" <= c <= "Z" for c in t), sum(c in "#$%&*|" for c in t), len(t))
        assert tuple(int(found[k][i]) for k in ("words", "distinct", "capitals", "symbols", "points")) == want


def test_spans_are_told_apart_by_their_bytes(monkeypatch):
    monkeypatch.setattr(filter_audit.Spans, "hashes", lambda self: np.zeros(len(self.first), np.uint64))
    texts = ["a b a c b longer-than-eight longer-than-eigh longer-than-eight", "a a", "b"]
    assert filter_audit.scan(*buffers(texts))["distinct"].tolist() == [5, 1, 1]


def test_no_documents_no_audit(spark, none):
    assert got_audit(none, spark.createDataFrame([(1, 1, 0)], LABEL)) == {}
    rows = spark.createDataFrame(ODD, DOC)
    assert all(v[4] == v[5] == 0 for v in got_audit(rows, spark.createDataFrame([], LABEL)).values())
