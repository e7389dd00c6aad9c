"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyspark.llm import (html_extract, huffman, jaccard_join, line_dedup, packing, piece_dropout, quality_rules,
                            syncmers, token_counts, toxicity)
from tallyspark.llm.queries import BYTE_BPE, PIECE_BPE, WORD_BPE, tokenizer_path
from tallyspark.session import scratch_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names the operators use themselves.
CLASHES = ["row", "m", "host", "score", "key", "rep", "component_id", "n_words", "kept", "removed", "lines", "gone", "h",
           "ids", "fp", "bucket", "k_id", "window_id", "digest", "distrusted", "t_id", "clean_text"]
LONG = " ".join(f"word{i} and some more {i % 7}" + ("\n" if i % 9 == 0 else "") for i in range(30_000))


@pytest.fixture(scope="module")
def odd(spark):
    passage = " ".join(f"passage{i}" for i in range(60))
    rows = [
        (None, None, None, None, None), (None, "a text without an id", "en", "src", 20), (1, None, "en", None, 0),
        (2, "", "en", "src", 0), (3, " \t\n\x0b\x0c\r ", None, "src", 7), (4, LONG, "en", "src", len(LONG)),
        (5, passage + "\nown line", "en", "src", 1), (5, passage + "\nown line", "en", "src", 1),
        (5, "another text under the same id", "en", "src", 1), (6, "intro\n" + passage, "en", "other", 1),
        (7, "É ünïcödé 中文 🎉 ▁ <|endoftext|> <s> \x00 " + passage, "fr", "src", 1), (8, "one", "en", "src", 3),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    return docs.select("*", *(F.lit(f"clash {c}").alias(c) for c in CLASHES)).repartition(3)


def _labels(spark):
    return spark.createDataFrame([(4, 1, 0), (5, 1, 1), (6, 0, None), (None, 1, 1), (7, 1, 0), (7, 1, 1)],
                                 "doc_id long, quality int, toxic int")


def _operators(spark):
    cache = scratch_path(spark, f"test-cache-{id(object())}")

    def files(docs):
        path = huffman.scratch_files(spark)
        huffman.write_ids(docs, tokenizer_path(WORD_BPE), path)
        return huffman.read_ids(spark, path)

    return {
        "quality": quality_rules.score_quality,
        "lines": line_dedup.dedup_lines,
        "toxicity": lambda d: toxicity.score_documents(d, _labels(spark)),
        "pieces": lambda d: piece_dropout.decode(piece_dropout.encode(d, tokenizer_path(PIECE_BPE)), tokenizer_path(PIECE_BPE)),
        "syncmers": syncmers.fingerprint_documents,
        "counts": lambda d: token_counts.count_tokens(d, tokenizer_path(BYTE_BPE), cache),
        "files": files,
        "packing": lambda d: packing.pack(d, tokenizer_path(WORD_BPE)),
        "jaccard": jaccard_join.near_duplicates,
    }


@pytest.mark.parametrize("name", ["quality", "lines", "toxicity", "pieces", "syncmers", "counts", "files", "packing", "jaccard"])
def test_operator_on_odd_and_empty_tables(spark, odd, name):
    run = _operators(spark)[name]
    out = run(odd).collect()
    if name == "packing":
        assert sum(1 for r in out if r.start == 0) == odd.count()
    else:
        assert len(out) == odd.count()
    assert run(spark.createDataFrame([], SCHEMA)).collect() == []
    if name == "quality":
        assert all(r.base_failed and not r.kept for r in out if r.n_words < 50)
    if name == "lines":
        five = {r.clean_text for r in out if r.doc_id == 5 and r.text.startswith("passage")}
        assert len(five) == 1 and "passage0" in five.pop()          # repeated rows share a result: the first copy stays
        assert [r.clean_text for r in out if r.doc_id == 6] == ["intro"]
        assert all(r.clean_text is None for r in out if r.text is None)
    if name == "pieces":
        texts = sorted((r.text or "") for r in odd.collect())
        assert sorted(r.decoded for r in out) == texts
    if name == "toxicity":
        assert all(0 <= r.score <= 1 for r in out) and all(r.held_out is None for r in out if r.doc_id is None)
    if name == "syncmers":
        empty = [r for r in out if r.doc_id in (2, 3)]
        assert all(r.fingerprint == "" for r in empty)
        assert len({r.fingerprint for r in out if r.doc_id == 5}) == 2
    if name == "counts":
        assert {r.n_tokens for r in out if r.n_bytes == 0} == {0}
    if name == "files":
        starts = sorted((r.start, r.n_tokens) for r in out)
        assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))
    if name == "jaccard":
        assert all(r.component_id == r.doc_id for r in out if r.n_shingles == 0)


def test_pages_odd_and_empty(spark):
    schema = "page_id long, url string, html string, text string, host string, part long, row string"
    rows = [(None, None, None, None, None, 1, None), (1, "http://h.example/x", "", "t", "h", 1, "r"), (1, "http://h.example/x", "", "t", "h", 1, "r"),
            (2, "not a url", "<p>plain", None, None, None, None), (3, "http://h.example/y", "<article>" + "<p>word " * 30_000, None, None, None, None),
            (4, None, "<div", None, None, None, None)]
    out = html_extract.extract_pages(spark.createDataFrame(rows, schema)).collect()
    assert len(out) == len(rows) and all(r.text is not None and r.n_chars == len(r.text) for r in out)
    assert {r.text for r in out if r.page_id == 2} == {"plain"}
    assert html_extract.extract_pages(spark.createDataFrame([], schema)).collect() == []


def test_pipeline_stages_on_odd_and_empty_tables(spark, odd, tmp_path):
    _labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    empty = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, str(tmp_path))
        rows = out.collect()
        assert stage(spark, empty, str(tmp_path)).collect() == []
        if name != "packing":
            assert out.columns == odd.columns, name
            assert all(r["row"] == "clash row" for r in rows)
