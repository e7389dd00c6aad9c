"""The corpus pipeline, stage by stage, against SQL or brute force on each stage's own input."""

import duckdb
import pytest

import corpus_pipeline
from tallyspark.llm import jaccard_join, line_dedup, quality_rules, toxicity
from tallyspark.llm.common import write_table

SF = "/root/testdata/sf0.001"


def _sql(docs, text):
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    return con.execute(text).df()


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        result = write_table(stage(spark, docs, SF), "test-stage")
        out[name] = (docs, result)
        docs = result
    return out


def _ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stage_columns_and_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "toxicity", "line_dedup", "jaccard_join", "packing"]
    for name, (before, after) in stages.items():
        if name != "packing":
            assert after.columns == before.columns and set(_ids(after)) <= set(_ids(before)) and after.count() > 0


def test_quality_stage_equals_sql(stages):
    before, after = stages["quality_rules"]
    verdicts = _sql(before, quality_rules.ORACLE_SQL)
    assert _ids(after) == sorted(verdicts[verdicts.kept].doc_id.tolist()) and len(verdicts) > len(_ids(after))
    assert after.exceptAll(before).isEmpty()


def test_toxicity_stage_drops_what_scores_toxic(spark, stages):
    before, after = stages["toxicity"]
    scored = toxicity.score_documents(before, spark.read.parquet(f"{SF}/labels.parquet"))
    assert _ids(after) == _ids(scored.where("score < 0.5")) and after.exceptAll(before).isEmpty()


def test_line_stage_equals_sql(stages):
    before, after = stages["line_dedup"]
    want = {r.doc_id: r.text for r in _sql(before, line_dedup.ORACLE_SQL).itertuples() if r.n_removed == 0 or r.text.split()}
    got = {r.doc_id: r for r in after.collect()}
    assert {i: r.text for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_near_duplicate_stage_keeps_one_of_each_group(stages):
    before, after = stages["jaccard_join"]
    groups = _sql(before, jaccard_join.oracle_sql(5, 4, 5))
    assert _ids(after) == sorted(groups.component_id.unique().tolist())


def test_packing_stage_covers_every_document(stages):
    before, after = stages["packing"]
    pieces = after.toPandas()
    assert sorted(pieces.doc_id.unique().tolist()) == _ids(before)
    assert (pieces.groupby("doc_id").length.sum() == pieces.groupby("doc_id").doc_tokens.first()).all()


def test_run_equals_the_stages(spark, stages):
    assert corpus_pipeline.run(spark, SF).count() == stages["packing"][1].count()
