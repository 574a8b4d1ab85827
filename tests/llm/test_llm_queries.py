"""Registered queries next to their SQL, and the pipeline next to a plain one."""

from __future__ import annotations

from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
from compare import connect, difference, type_difference
from samples import FOLDER
from plain import base_counts, linked

from obsmart.llm.common import stage
from obsmart.llm.queries import ORACLES, QUERIES
from obsmart.llm.tokens import encoder, tokenizer_path

SMALL = "/root/testdata/sf0.01"


def test_a_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    duck = connect(SMALL)
    df = QUERIES[name](spark, SMALL)
    assert type_difference(df, duck, ORACLES[name]) is None
    assert difference(df, duck, ORACLES[name]) is None


def test_native_operators_run_no_python(spark):
    for name in ("op1_quality_cascade", "op7_license_scan"):
        plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "InPandas")), name


def test_pipeline_stages(spark, docs):
    frames = [docs]
    for name, work in corpus_pipeline.STAGES:
        frames.append(stage(work(spark, frames[-1], FOLDER), f"test-{name}"))
    for frame in frames[1:-1]:
        assert frame.columns == docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    good = {r.doc_id for r in frames[1].collect()}
    for i, text in texts.items():
        n, chars, symbols, _, repeated = base_counts(text)
        if n < 10 or 100 * repeated > 20 * n or 100 * symbols > 30 * n:
            assert i not in good
    groups = linked([(i, texts[i]) for i in good], 5, 80)
    first = sorted(i for i, v in groups.items() if v[1] == i)
    assert sorted(r.doc_id for r in frames[2].collect()) == first
    mixed = Counter(r.doc_id for r in frames[3].collect())
    assert set(mixed) <= set(first) and max(mixed.values()) <= 3
    tokens = defaultdict(int)
    for r in frames[4].collect():
        tokens[r.doc_id] += r.length
        assert len(np.frombuffer(r.ids, "<u4")) == r.length
    coder = encoder(tokenizer_path()).tokenizer
    for i, copies in mixed.items():
        assert tokens[i] == copies * (len(coder.encode(texts[i], add_special_tokens=False).ids) + 1)


def test_pipeline_of_odd_and_no_rows(spark, odd, none):
    for rows in (odd, none):
        frame = rows
        for name, work in corpus_pipeline.STAGES:
            frame = stage(work(spark, frame, FOLDER), f"odd-{name}")
        assert (frame.count() > 0) == (rows is odd)
