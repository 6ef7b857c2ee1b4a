"""The registered queries: with SQL against DuckDB, and the pipeline's stages."""

import corpus_pipeline
import oracle
import pytest

import __spark_entry__ as driver
from orderlake.llm import entries, jaccard, kneser, mixing, packing

SF = f"{oracle.TESTDATA}/sf0.001"


def test_all_are_registered():
    assert {name.split("_")[0] for name in entries.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(entries.QUERIES) | {"pipeline"} <= set(driver.queries())
    assert set(entries.SQL) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", list(entries.SQL))
def test_query_equals_sql(spark, name):
    assert oracle.mismatch(entries.QUERIES[name](spark, SF), oracle.connect(SF), entries.SQL[name]) is None


def test_chat_runs_no_python(spark):
    plan = entries.QUERIES["op10_chat"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_pipeline_stages(spark):
    """Each stage against a plain reading of its decision."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, steps = docs.columns, dict(corpus_pipeline.STAGES)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = steps["quality_classifier"](spark, docs, SF)
    kept = {r.doc_id for r in kneser.judge(docs, labels).where("kept").collect()}
    assert good.columns == columns and {r.doc_id for r in good.collect()} == kept
    single = steps["exact_dedup"](spark, good, SF)
    last = {}
    for r in good.collect():
        last[r.text] = max(r.doc_id, last.get(r.text, r.doc_id))
    assert single.columns == columns and {r.doc_id for r in single.collect()} == set(last.values())
    near = steps["near_dedup"](spark, single, SF)
    want = {r.doc_id for r in jaccard.classes(single).collect() if r.doc_id == r.component_id}
    assert near.columns == columns and {r.doc_id for r in near.collect()} == want
    mixed = steps["mix_sources"](spark, near, SF)
    taken = mixing.mix_sizes(near).agg({"taken": "sum"}).first()[0]
    words = sum(len((r.text or "").split()) for r in mixed.collect())
    assert mixed.columns == columns and abs(words - taken) <= 1
    packed = steps["pack_sequences"](spark, mixed, SF)
    assert packed.selectExpr("sum(length)").first() == packing.pieces(mixed).selectExpr("sum(length)").first()


def test_pipeline_runs(spark):
    out = driver.queries()["pipeline"](spark, SF).collect()
    assert out and max(r.offset + r.length for r in out) <= packing.WINDOW
