"""Awkward and empty inputs have their defined results and never crash."""

import pytest
from llm_helpers import awkward
from pyspark.sql import functions as F

import corpus_pipeline
from ledgermatch.llm import (
    decontaminate, exact_dedup, licenses, line_dedup, mixing, queries, secrets, simhash, token_store, toxicity, warc_zip,
)

MODEL = toxicity.train(["you stupid clown", "a fine day"] * 30, __import__("numpy").array([1, 0] * 30))


def items(spark):
    return spark.createDataFrame(
        [(1, "a benchmark question that is certainly long enough to search"), (2, None), (3, ""), (4, "short"),
         (5, "a benchmark question that is certainly long enough to search")], "item_id long, text string")


OPERATORS = {
    "secrets": lambda s, d: secrets.contract_columns(secrets.scan_secrets(d)),
    "line_dedup": lambda s, d: line_dedup.dedup_lines(d),
    "mixing": lambda s, d: mixing.mix(d, queries.source_domain(), {}, F.col("tokens")),
    "toxicity": lambda s, d: d.select("doc_id", toxicity.score_column(F.col("text"), MODEL).alias("p")),
    "decontaminate": lambda s, d: decontaminate.find_items(d, items(s)),
    "licenses": lambda s, d: licenses.scan_licenses(d),
    "all licenses": lambda s, d: licenses.scan_all_licenses(d),
    "simhash": lambda s, d: simhash.near_duplicates(d),
    "token_store": lambda s, d: token_store.token_counts(d),
    "exact_dedup": lambda s, d: exact_dedup.exact_duplicates(d),
    "warc": lambda s, d: warc_zip.round_trip(d.withColumn("url", F.lit(None).cast("string")), id_col="doc_id",
                                             payload_col="text"),
}
KEEP_ROWS = {"drop_exact": exact_dedup.drop_exact_duplicates, "drop_near": simhash.drop_near_duplicates}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_awkward_rows(spark, name):
    docs = awkward(spark)
    rows = OPERATORS[name](spark, docs).collect()
    if name != "mixing":
        assert len(rows) == docs.count()
    if name == "exact_dedup":
        by = {(r.doc_id, r.text_sha256): r for r in rows}
        assert sum(r.kept for r in rows) == len({r.text_sha256 for r in rows})
        assert {r.keep_id for r in rows if r.doc_id in (1, 2)} == {1}
        assert [r.keep_id for (i, _), r in by.items() if i == 4] == [3]  # null is empty
    if name == "simhash":
        blank = [r for r in rows if r.fp == 0]
        assert {r.doc_id for r in blank} >= {3, 4, 5, 9} and {r.component_id for r in blank} == {3}
    if name == "line_dedup":
        assert {r.n_lines for r in rows if r.doc_id == 9} == {50_001}
        assert {r.n_dropped for r in rows if r.doc_id == 1} == {1} and {r.n_dropped for r in rows if r.doc_id == 2} == {0}
    if name == "token_store":
        assert {r.n_tokens for r in rows if r.doc_id in (3, 4)} == {0}
    if name == "toxicity":
        assert all(0 <= r.p <= 1 for r in rows)
    if name == "mixing":
        assert not {r.doc_id for r in rows} & {3, 4, 5, 9} and {r.doc_id for r in rows} >= {1, 2, 6, None}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, awkward(spark).limit(0)).collect() == []


@pytest.mark.parametrize("name", sorted(KEEP_ROWS))
def test_filters_keep_columns_and_one_row(spark, name):
    docs = awkward(spark)
    kept = KEEP_ROWS[name](docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert sum(r.doc_id == 1 for r in rows) == 1 and not any(r.doc_id == 2 for r in rows)
    assert sum(r.doc_id is None and r.text == "no identifier" for r in rows) == 1
    assert KEEP_ROWS[name](docs.limit(0)).collect() == []


@pytest.mark.parametrize("step", range(5))
def test_stages_on_awkward_rows(spark, tmp_path, step):
    docs = awkward(spark)
    spark.createDataFrame([(1, 0, 0), (6, 1, 1), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(
        f"file://{tmp_path}/labels.parquet")
    items(spark).write.parquet(f"file://{tmp_path}/benchmark.parquet")
    _, stage = corpus_pipeline.STAGES[step]
    for rows in (docs, docs.limit(0)):
        out = stage(spark, rows, f"file://{tmp_path}")
        out.collect()
        assert step == 4 or out.columns == docs.columns
