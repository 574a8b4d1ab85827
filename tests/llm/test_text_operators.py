"""Quality rules, mixing, packing, sharding, wavelet files and licences against plain versions."""

from __future__ import annotations

import textwrap
import zlib
from collections import defaultdict

import numpy as np
import pytest
from samples import DOC, LONG, ODD
from plain import base_counts, words
from pyspark.sql import functions as F

from obsmart.llm import common, license_scan, mixing, packing, quality_rules, sharding, wavelet
from obsmart.llm.tokens import encoder, tokenizer_path
from obsmart.session import fresh_dir


def ids_of(text):
    return np.array(encoder(tokenizer_path()).tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")


# --- quality -----------------------------------------------------------------
def test_base_counts_equal_the_plain_ones(odd, docs):
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for df in (odd, docs):
        for r in quality_rules.base(df).select("row.text", *counts, "base_failed").collect():
            want = base_counts(r[0])
            assert tuple(r[1:6]) == want, r[0]
            assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])


def test_order_of_rules_changes_no_verdict(docs):
    names = [r.name for r in quality_rules.RULES]
    found = quality_rules.base(docs)
    kept = []
    for rules in (quality_rules.RULES, quality_rules.RULES[::-1]):
        judged = quality_rules.cascade(found, list(rules), F.col("base_failed"))
        kept.append({tuple(r) for r in judged.where("failed_rule is null").select("row.doc_id", "base_failed").collect()})
        assert {r[0] for r in judged.select("failed_rule").distinct().collect()} <= {None, *names}
    assert kept[0] == kept[1]


def test_rules_are_sorted_by_rejections_per_second():
    a, b, c = (quality_rules.Rule(n, lambda: F.lit(False)) for n in "abc")
    assert [r.name for r in quality_rules.ordered([(a, 1.0, 0.1), (b, 0.1, 0.05), (c, 1.0, 0.1)])] == ["b", "a", "c"]


def test_rules_are_measured_on_rows_that_pass_the_base_limits(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = {rule.name: share for rule, _, share in quality_rules.measured(docs, quality_rules.RULES, rows=2000)}
    passing = quality_rules.base(docs).where(~F.col("base_failed"))
    for rule in quality_rules.RULES:
        want = passing.where(rule.rejects()).count() / passing.count()
        assert abs(found[rule.name] - want) < 0.02, rule.name


def test_the_timed_sample_has_few_tasks_however_many_the_table_has(spark, monkeypatch):
    stored = []

    def noted(df, label):
        stored.append(common.stage(df, label))
        return stored[-1]

    monkeypatch.setattr(quality_rules, "stage", noted)
    words = F.concat_ws(" ", *[F.concat(F.lit(f"word{k}x"), F.col("id").cast("string")) for k in range(12)])
    docs = spark.range(400).repartition(40).select(words.alias("text"))
    quality_rules.measured(docs, quality_rules.RULES)
    assert stored[0].count() == 400 and len(stored[0].inputFiles()) <= quality_rules.SAMPLE_TASKS


def test_kept_rows_have_their_own_columns(odd, none):
    kept = quality_rules.kept(odd)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {None}  # the long texts repeat themselves
    assert quality_rules.kept(none).count() == 0


def test_clean_labelled_documents_stay(spark, docs):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").where("quality = 1").select("doc_id")
    judged = quality_rules.judged(docs).select("row.doc_id", "base_failed", "kept").join(labels, "doc_id")
    assert judged.where("not kept and not base_failed").count() == 0 and judged.count() > 30


# --- mixing ------------------------------------------------------------------
def test_targets_fill_up_by_weight(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 500), (None, 30)], "source string, size long")
    got = {r.source: r.target for r in mixing.targets(sizes).collect()}
    assert got["a"] == 30 and sum(got.values()) == pytest.approx(1540)
    # weights 5, 2, 1, 5: a and the null source are full at 30 and 90; b and c share the rest as 2 to 1
    assert got[None] == 90 and got["b"] == pytest.approx(2 * got["c"]) == pytest.approx(1420 * 2 / 3)


def test_plan_and_emission_agree(odd, none):
    planned = mixing.plan(odd)
    rows = planned.select("row.doc_id", "row.text", "mix.*").collect()
    for r in rows:
        assert r.size == len(words(r.text)) and 0 <= r.copies <= 3
    again = {(r.doc_id, r.text): r.copies for r in mixing.plan(odd).select("row.doc_id", "row.text", "mix.copies").collect()}
    assert again == {(r.doc_id, r.text): r.copies for r in rows}
    emitted = mixing.emit(planned)
    assert emitted.columns == odd.columns and emitted.count() == sum(r.copies for r in rows)
    assert mixing.emit(mixing.plan(none)).count() == 0


def test_rows_without_or_with_shared_ids_draw_apart(spark):
    rows = [(None if i % 2 else 7, f"{'word ' * (20 + i % 60)}{i if i % 5 else ''}", "en", "abc"[i % 3], 0) for i in range(900)]
    planned = mixing.plan(spark.createDataFrame(rows, DOC))
    found = planned.groupBy("row.source").agg(F.sum(F.col("mix.size") * F.col("mix.copies")).alias("taken"), F.first("mix.target").alias("target")).collect()
    assert len(found) == 3 and all(abs(r.taken / r.target - 1) < 0.15 for r in found)
    again = mixing.plan(spark.createDataFrame(rows, DOC)).agg(F.sum(F.col("mix.size") * F.col("mix.copies"))).first()[0]
    assert again == sum(r.taken for r in found)


# --- tokens, packing ------------------------------------------------------------
def test_word_by_word_ids_equal_those_of_the_whole_text(docs):
    import pyarrow as pa

    texts = [r[1] for r in ODD] + [r.text for r in docs.limit(60).collect()] + ["ΣΑΣ İ ﬁ é.", "we'll, it's: 'S d'!", "<|ENDOFTEXT|> a|b"]
    for cache in (50, 100_000):
        coder = type(encoder(tokenizer_path()))(tokenizer_path(), cache)
        flat, counts = coder.encode(pa.array(texts, pa.large_string()))
        ends = np.cumsum(counts)
        for text, a, b in zip(texts, ends - counts, ends, strict=True):
            assert flat[a:b].tolist() == ids_of(text).tolist()


def test_differencing_is_near_equal_and_raises_the_number_of_windows():
    lengths = np.array([8, 7, 6, 5, 4])
    placed = packing.differencing(lengths, 2)
    assert sorted(np.bincount(placed, lengths).astype(int)) in ([14, 16], [15, 15])
    item, pieces, window = packing.windows_for(np.array([60, 60, 60]), 100)
    sums = np.bincount(window, pieces)
    assert sums.max() <= 100 and pieces.sum() == 180 and np.bincount(item, pieces).astype(int).tolist() == [60, 60, 60]


def test_pieces_cover_each_document_once(odd, docs, none):
    for df in (odd, docs):
        rows = packing.pack(df).collect()
        sequences, covered = defaultdict(list), defaultdict(list)
        for r in rows:
            sequences[r.sequence_id].append((r.offset, r.length))
            covered[r.doc_id].append(r)
        for pieces in sequences.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
            assert 0 < at <= packing.WINDOW
        texts = defaultdict(list)
        for r in df.select("doc_id", "text").collect():
            texts[r.doc_id].append(r.text)
        for name, own in texts.items():
            want = sum((ids_of(t).tolist() for t in own), [])
            if len(own) == 1:
                got = b"".join(r.ids for r in sorted(covered[name], key=lambda r: r.start))
                assert np.frombuffer(got, "<u4").tolist() == want and {r.doc_tokens for r in covered[name]} == {len(want)}
            else:
                assert sum(r.length for r in covered[name]) == len(want)
    assert packing.pack(none).count() == 0


# --- sharding ------------------------------------------------------------------
def test_shards_slots_and_growth(odd, none):
    rows = sharding.shard(odd).collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert 0 <= r.shard < 40 and r.grown_shard in (r.shard, 40)
    assert len(rows) == len(ODD) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    texts = {i: (t or "").encode() for i, t, *_ in ODD}
    assert all(r.size == len(texts[r.doc_id]) + 16 and r.text_crc32 == zlib.crc32(texts[r.doc_id]) for r in rows)
    assert sharding.shard(none).count() == 0


def test_growing_moves_keys_into_the_new_shard_alone():
    keys = np.arange(40_000, dtype=np.int64).view(np.uint64)
    before = sharding.place(keys, sharding.tree(40))
    counts = np.bincount(before, minlength=40)
    assert 850 < counts.min() and counts.max() < 1150
    for n in (41, 42, 43):
        after = sharding.place(keys, sharding.tree(n))
        moved = after != before
        assert (after[moved] == n - 1).all() and 0.5 < moved.mean() * n < 1.6
        before = after


def test_one_shard_more_is_what_was_announced(docs, odd):
    def column(df, name, *args, **more):
        return sorted((r.doc_id is None, r.doc_id, r.text_crc32, r[name]) for r in sharding.shard(df, *args, **more).collect())

    for df in (docs, odd.where("doc_id is not null")):
        for n in (40, 41):
            assert column(df, "shard", n + 1) == column(df, "grown_shard", n)
    weights = {3: 3.0, 8: 20.0}
    grown = column(docs, "grown_shard", 8, first=8, weights=weights)
    assert column(docs, "shard", 9, first=8, weights=weights) == grown and sum(r[3] == 8 for r in grown) > len(grown) / 2
    with pytest.raises(ValueError, match="first"):
        sharding.shard(docs, 8)


def test_a_heavier_shard_takes_from_the_others_in_proportion():
    keys = np.arange(40_000, dtype=np.int64).view(np.uint64)
    counts = np.bincount(sharding.place(keys, sharding.tree(8, 8, {3: 3.0})), minlength=8)
    assert 2.6 < counts[3] / np.delete(counts, 3).mean() < 3.4


# --- wavelet files ----------------------------------------------------------------
def test_rank_select_access():
    ids = np.random.default_rng(1).integers(0, 300, 5000).astype(np.uint16)
    matrix = wavelet.WaveletMatrix.build(ids, 9)
    assert (matrix.all_ids() == ids).all()
    for at in (0, 17, 4999):
        assert matrix.access(at) == ids[at]
    for token in (0, 5, 299, 511, 4000):
        places = np.flatnonzero(ids == token).tolist()
        assert matrix.occurrences(token) == places and matrix.count(token, 100, 900) == (ids[100:900] == token).sum()
        assert matrix.select(token, len(places)) == -1 and matrix.rank(token, 2500) == (ids[:2500] == token).sum()


def test_files_give_back_every_document(spark, odd, none):
    folder = fresh_dir(spark, "wavelet-test")
    files = wavelet.write(odd, folder, shard_ids=50)
    rows = sorted(wavelet.read(files, folder).collect(), key=lambda r: r.start)
    assert files.count() > 3 and len(rows) == len(ODD)
    at = 0
    for r in rows:
        assert r.start == at and r.n_tokens == len(np.frombuffer(r.ids, "<u4"))
        at += r.n_tokens
    names = [r.doc_id for r in rows]
    assert names[0] is None and names[1:] == sorted(i for i, *_ in ODD if i is not None)
    texts = {i: t for i, t, *_ in ODD}
    assert all(np.frombuffer(r.ids, "<u4").tolist() == ids_of(texts[r.doc_id]).tolist() for r in rows)
    empty = fresh_dir(spark, "wavelet-none")
    assert wavelet.read(wavelet.write(none, empty), empty).count() == 0


# --- licences ---------------------------------------------------------------------
def test_nearest_licensed_directory_wins(spark):
    rows = [
        (1, "a", "Released under the MIT License."), (2, "a/b", "Licensed under the Apache License, Version 2.0"),
        (3, "a/b/c", "nothing"), (4, "a/d", None), (5, "ab", "x"), (6, "a/b", "text " * 50 + "\nLicensed under CC BY-NC 4.0."),
    ]
    got = {r.key: r for r in license_scan.scan(spark.createDataFrame(rows, "key long, dir string, text string")).collect()}
    assert [got[k].licence for k in range(1, 7)] == ["MIT", "Apache-2.0", "Apache-2.0", "MIT", None, "CC-BY-NC-4.0"]
    assert [got[k].licence_file for k in range(1, 7)] == [True, True, False, False, False, False]
    assert got[3].inherited_from == "a/b" and got[6].inherited == "Apache-2.0"


def test_headers_and_whole_texts_declare_and_near_misses_do_not(spark):
    def commented(text, mark="# ", width=60):
        return "\n".join((mark + line).rstrip() for part in text.split("\n") for line in textwrap.wrap(part, width) or [""])

    code = "\n\n" + "\n".join(f"value_{i} = compute(value_{i - 1}, step={i})" for i in range(60))
    full = {licence: text for licence, needs, text in license_scan.TEXTS}  # the longest of each comes last
    heads = {licence: text for licence, needs, text in reversed(license_scan.TEXTS)}
    want = {}
    for licence, text in heads.items():
        if licence != "Zlib":
            want[commented(text) + code] = licence
            want[commented(f"Copyright (c) 2021 A. Person\n\n{text}", " * ") + code] = licence
    for licence, text in full.items():
        want[f"Copyright 2001 Some Body\n\n{text.replace('. ', '.' + chr(10) * 2)}"] = licence
        want["\n".join(textwrap.wrap(text, 72))] = licence
    for licence in ("MIT", "GPL-3.0", "Apache-2.0", "BSD-2-Clause", "CC-BY-SA-4.0"):
        want[f"// SPDX-License-Identifier: {licence}\nint main() {{ return 0; }}" + code] = licence
    want["This file is released under the MIT License, see LICENSE for details." + code] = "MIT"
    want["Distributed under the MIT License" + code] = "MIT"
    for near in (
        "SPDX-License-Identifier: EPL-2.0", "You need a driving license to drive home with it", "Permission to park here is hereby granted to residents only.",
        "Licensed under the Example Corp. License, version 2.0", "The film was released under the name of its author",
        "The MIT press published a book on the license question, which many people in the town read with great interest and pleasure",
        "the general said that two of three licensed dealers had gone", "Redistribution of wealth in binary forms of society",
    ):
        want[near + code] = None
    rows = [(k if k else None, f"d{k}", text) for k, text in enumerate(want)]
    got = {r.key: r for r in license_scan.scan(spark.createDataFrame(rows, "key long, dir string, text string")).collect()}
    wrong = [(licence, got[k or None].declared, got[k or None].cosine, text[:80]) for k, (text, licence) in enumerate(want.items()) if got[k or None].declared != licence]
    assert not wrong


def test_licences_of_odd_and_no_rows(odd, none):
    files = odd.select(F.col("doc_id").alias("key"), license_scan.document_dir().alias("dir"), "text")
    got = license_scan.scan(files).collect()
    assert len(got) == len(ODD) and {r.key: r.declared for r in got}[-12] == "CC-BY-NC-4.0"
    assert license_scan.scan(none.select(F.col("doc_id").alias("key"), F.lit("x").alias("dir"), "text")).count() == 0


def test_very_long_text_is_encoded_whole():
    coder = encoder(tokenizer_path())
    flat, counts = coder._encode_long(LONG)
    assert counts.tolist() == [len(flat)] and flat.tolist() == ids_of(LONG).tolist()
