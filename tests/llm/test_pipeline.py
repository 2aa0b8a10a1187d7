"""The corpus pipeline stage by stage, and the operators' SQL oracles."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from cinepulse.llm import packing, pii
from cinepulse.llm.common import documents, staged
from cinepulse.llm.queries import OPERATORS, ORACLE

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert {*OPERATORS, "pipeline"} <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_oracle(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    got = OPERATORS[name](spark, SF)
    cols = sorted(got.columns)
    rel = con.sql(f"SELECT {', '.join(cols)} FROM ({ORACLE[name]})")
    assert sorted(tuple(r[c] for c in cols) for r in got.collect()) == sorted(rel.fetchall())


def test_stages(spark):
    docs = documents(spark, SF)
    cols, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "pii", "packing"]

    good = staged(spark, corpus_pipeline.keep_quality(spark, docs, SF), "t")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in good.collect()}
    clean = [i for i, q in labels.items() if q == 1]
    assert good.columns == cols and len(kept & set(clean)) >= 0.97 * len(clean) and len(kept) < len(before)

    once = staged(spark, corpus_pipeline.drop_exact_copies(spark, good, SF), "t")
    last = {}
    for i in sorted(kept):
        last[before[i].text] = i
    assert once.columns == cols and {r.doc_id for r in once.collect()} == set(last.values())

    single = staged(spark, corpus_pipeline.drop_near_copies(spark, once, SF), "t")
    from test_operators import _components

    comps = _components([(r.doc_id, r.text) for r in once.collect()])
    assert single.columns == cols and {r.doc_id for r in single.collect()} == {i for i, (_, c) in comps.items() if i == c}

    masked = staged(spark, corpus_pipeline.mask_personal_data(spark, single, SF), "t")
    crf = pii.fit()
    for r in masked.collect():
        text = before[r.doc_id].text
        assert r.text == pii.mask(text, pii.all_spans([text], crf)[0][1]) and r.n_chars == len(r.text)
        assert pii.base_spans(r.text) == []
    assert masked.columns == cols

    packed = corpus_pipeline.pack_sequences(spark, masked, SF)
    assert packed.columns == [c.split()[0] for c in packing.PIECES.split(", ")]
    ends = {r.doc_id: r.doc_tokens for r in packed.collect()}
    assert set(ends) == {r.doc_id for r in masked.collect()}


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and sum(r.length for r in rows) == sum({r.doc_id: r.doc_tokens for r in rows}.values())
