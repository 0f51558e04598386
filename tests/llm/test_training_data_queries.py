"""The training-data queries on the smallest tables, and the pipeline stage by stage."""

import hashlib
from pathlib import Path

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from moodline.llm import queries as registry
from moodline.llm.common import fold, words

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="test tables are not here")

COLUMNS = {
    1: "query_id rank vec_id score",
    2: "doc_id toxic",
    3: "doc_id keep_id group_size kept text_sha256",
    4: "doc_id n_tokens ids_sha256 decoded_sha256",
    5: "doc_id held_out n_tokens n_known train_tokens base_score score",
    6: "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    7: "page_id url text n_chars",
    8: "doc_id n_shingles component_id",
    9: "doc_id size source_size target taken",
    10: "doc_id held_out lang_pred score",
    11: "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
    12: "doc_id held_out score predicted",
    13: "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
}


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in ("documents", "embeddings"):
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def test_all_are_registered():
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in contract.queries() and set(registry.ORACLE) <= set(names)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, str(SF))
    n = int(name[2:].split("_")[0])
    assert set(COLUMNS[n].split()) <= set(df.columns)
    rows = df.collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    if name in registry.ORACLE:
        result = duck.sql(registry.ORACLE[name])
        assert sorted(result.columns) == sorted(df.columns)
        own = [tuple(r[c] for c in result.columns) for r in rows]
        assert sorted(own) == sorted(result.fetchall())
    elif n == 7:
        assert len(rows) == 50 and all(r.text.strip() == r.text and r.n_chars == len(r.text) for r in rows)
        assert all("<" not in r.text for r in rows)
    else:
        assert {r.doc_id for r in rows} == set(docs) and len(rows) == len(docs)
    if n == 4:
        for r in rows:
            assert r.decoded_sha256 == hashlib.sha256((docs[r.doc_id].text or "").encode()).hexdigest()
    if n == 5:
        assert all(r.held_out == (fold(r.doc_id, 7) == 2) for r in rows)
        assert all(r.n_tokens == len(words(docs[r.doc_id].text)) + 1 for r in rows)
    if n == 10:
        held_out = [r for r in rows if r.held_out]
        assert sum(r.lang_pred == docs[r.doc_id].lang for r in held_out) >= 0.95 * len(held_out)


def test_pipeline_stage_by_stage(spark):
    """Every stage against what its decision means, on all that its predecessor kept."""
    from moodline.session import stage

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before = docs.collect()
    for k, (name, apply) in enumerate(corpus_pipeline.STAGES):
        after_df = stage(apply(spark, docs, str(SF)), f"test-{k}")
        after = after_df.collect()
        if k + 1 < len(corpus_pipeline.STAGES):
            assert after_df.columns == columns, name
        ids, kept = [r.doc_id for r in before], [r.doc_id for r in after]
        assert set(kept) <= set(ids)
        if name == "toxicity":
            clean = [i for i in ids if labels.get(i) == 0]
            assert len(set(clean) & set(kept)) >= 0.95 * len(clean) and len(kept) < len(ids)
        if name == "exact dedup":
            texts = {}
            for r in before:
                texts.setdefault(" ".join(words_kept(r.text)), []).append(r.doc_id)
            assert sorted(kept) == sorted(min(v) for v in texts.values())
        if name == "n-gram jaccard join":
            sets = {r.doc_id: shingles(r.text) for r in after}
            full = [s for s in sets.values() if s]
            assert not any(
                100 * len(a & b) >= 80 * len(a | b) for i, a in enumerate(full) for b in full[:i] if not a.isdisjoint(b)
            )
        if name == "mixing":
            assert len(kept) > 0.9 * len(ids)
        if name == "bpe":
            assert sorted(kept) == sorted(ids)
            assert sorted(r.text for r in after) == sorted(r.text for r in before)
            assert all(len(r.ids) == 4 * r.n_tokens for r in after)
        docs, before = after_df, after


def words_kept(text):
    import re

    return re.split(r"[\x20\x09-\x0D]+", text or "")


def shingles(text):
    w = words(text)
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
