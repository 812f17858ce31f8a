"""The queries against DuckDB where SQL can express them, and the pipeline against its parts."""

import importlib
import sys
from pathlib import Path

import pytest
from compare import connect, difference
from conftest import SMALL

sys.path.insert(0, str(Path(__file__).parent))
from samples import TEXTS, contamination, documents, jaccard  # noqa: E402

entry = importlib.import_module("__spark_entry__")
pipeline = importlib.import_module("corpus_pipeline")
from bidlift.llm.oracle import ORACLE  # noqa: E402
from bidlift.llm.queries import QUERIES  # noqa: E402


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())
    assert [q.split("_")[0] for q in QUERIES] == [f"op{n}" for n in range(1, 14)]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, SMALL), connect(SMALL), ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_gives_a_row_for_every_input_row(spark, name):
    table, key = {"op9_url_rules": ("pages", "page_id"), "op11_chebyshev_whitening": ("embeddings", "vec_id")}.get(name, ("documents", "doc_id"))
    rows = QUERIES[name](spark, SMALL)
    assert rows.select(key).distinct().count() == spark.read.parquet(f"{SMALL}/{table}.parquet").count()


def test_stages_one_by_one(spark):
    """Each stage works on what the one before kept; its decisions hold against plain versions."""
    from bidlift.llm import secrets

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    seen = docs
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, seen, SMALL)
        assert out.columns == docs.columns, name
        before = {r.doc_id: r.text for r in seen.collect()}
        after = {r.doc_id: r.text for r in out.collect()}
        assert set(after) <= set(before)
        if name == "quality":
            judged = connect(SMALL).execute(f"SELECT doc_id FROM ({ORACLE['op8_adaptive_quality']}) WHERE kept").fetchall()
            assert set(after) == {i for (i,) in judged}
        if name == "near_duplicates":
            found = jaccard(sorted(before.items()), 5, 80)
            assert set(after) == {c for _, _, c, _ in found}
        if name == "benchmark":
            items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
            assert set(after) == {i for i, _, _, _, bad in contamination(sorted(before.items()), items) if not bad}
        if name == "secrets":
            assert set(after) == set(before)
            held = {r.doc_id for r in secrets.scan_secrets(seen).where("spans <> ''").collect()}
            assert {i for i in after if after[i] != before[i]} == held
            assert secrets.scan_secrets(out).where("spans <> ''").count() == 0
        from bidlift.session import materialize

        seen = materialize(out, name)
    rows = pipeline.STAGES[-1][1](spark, seen, SMALL).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in seen.collect()}


def test_stages_on_awkward_documents(spark):
    for texts in (TEXTS, []):
        docs = documents(spark, texts)
        for _, stage in pipeline.STAGES[:-1]:
            out = stage(spark, docs, SMALL)
            assert out.columns == docs.columns
            out.count()
        assert pipeline.STAGES[-1][1](spark, docs, SMALL).count() >= len(texts)
