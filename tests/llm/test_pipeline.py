"""The pipeline against a plain version of each stage, on the smallest tables."""

import importlib

import pytest

import corpus_pipeline
from tests.llm.test_documents import ITEMS, groups, hits


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [("input", docs.collect())]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.land(stage(spark, docs, sf), name)
        out.append((name, docs.collect()))
    return out, docs.columns


def test_stages_in_order(stages):
    assert [n for n, _ in stages[0]] == ["input", "language", "near_dedup", "decontaminate", "mix", "shard"]


def test_columns_stay_until_the_last(spark, sf, stages):
    columns = spark.read.parquet(f"{sf}/documents.parquet").columns
    assert all(list(rows[0].asDict()) == columns for _, rows in stages[0][:-1] if rows)
    assert stages[1][: len(columns)] == columns and {"shard", "slot", "size"} <= set(stages[1])


def test_language_keeps_text_with_letters(stages):
    out = dict(stages[0])
    before, after = out["input"], out["language"]
    assert len(after) >= 0.98 * len(before) and {r.doc_id for r in after} <= {r.doc_id for r in before}
    assert all(any(c.isalpha() for c in r.text or "") for r in after)


def test_dedup_against_all_pairs(stages):
    out = dict(stages[0])
    before = [(r.doc_id, r.text) for r in out["language"]]
    want = {c for _, n, c in groups(before, 5, 80) if n}
    assert {r.doc_id for r in out["near_dedup"]} == want


def test_leaks_against_brute_force(spark, sf, stages):
    out = dict(stages[0])
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    before = [(r.doc_id, r.text) for r in out["near_dedup"]]
    bad = {h[0] for h in hits(before, items) if h[2]}
    assert bad and {r.doc_id for r in out["decontaminate"]} == {d for d, _ in before} - bad
    assert ITEMS


def test_mix_and_shards(stages):
    out = dict(stages[0])
    kept = {r.doc_id for r in out["mix"]}
    assert kept <= {r.doc_id for r in out["decontaminate"]} and len(kept) > 0.5 * len(out["decontaminate"])
    assert {r.doc_id for r in out["shard"]} == kept
    sizes = [sum(r["size"] for r in out["shard"] if r.shard == s) for s in range(8)]
    assert max(sizes) - min(sizes) <= 2 * max(r["size"] for r in out["shard"])


def test_run_is_the_stages(spark, sf, stages):
    assert sorted(map(str, corpus_pipeline.run(spark, sf).collect())) == sorted(map(str, dict(stages[0])["shard"]))


def test_registered():
    entry = importlib.import_module("__spark_entry__")
    assert "pipeline" in entry.queries() and "pipeline" not in entry.oracle_sql()
