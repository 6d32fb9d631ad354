"""Every operator over nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fieldbook.llm import (
    bpe, decontamination, extraction, imatch, masked_lm, neighbours, nnpu, partenum, secret_scan, string_kernel, suffix_dedup,
)
from fieldbook.llm.queries import byte_bpe_path

SF = "/root/testdata/sf0.001"


def labels(spark, empty=False):
    df = spark.createDataFrame([(1, 1, 0), (5, 1, 1), (6, 0, 1), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    return df.limit(0) if empty else df


def benchmark(spark, empty=False):
    rows = [(1, "Alpha beta gamma delta epsilon zeta"), (1, "Alpha beta gamma delta epsilon zeta"), (2, None), (None, ""), (3, "x")]
    df = spark.createDataFrame(rows, "item_id bigint, text string")
    return df.limit(0) if empty else df


def quality(df, none):
    spark = df.sparkSession
    return nnpu.score(df, nnpu.train(df, labels(spark, none), F.col("quality") == 1))


def toxicity(df, none):
    spark = df.sparkSession
    return string_kernel.score(df, string_kernel.train(df, labels(spark, none), F.col("toxic") == 1, F.col("toxic") == 0))


OPERATORS = {
    "imatch": lambda df, none: imatch.fingerprints(df, imatch.lexicon(df)).select("doc_id", "signature"),
    "next": lambda df, none: neighbours.with_next(df.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "doc_id", "text", "n").where(f"NOT {neighbours.IS_COPY}"),
    "secrets": lambda df, none: secret_scan.find_secrets(df, owner=F.col("source"), repository=F.col("lang")),
    "partenum": lambda df, none: partenum.near_duplicates(df),
    "nnpu": quality,
    "suffix": lambda df, none: suffix_dedup.remove_repeats(df),
    "kernel": toxicity,
    "html": lambda df, none: extraction.extract_pages(df, "text", ("doc_id", "key")),
    "bpe": lambda df, none: bpe.tokenise(df, byte_bpe_path()),
    "lm": lambda df, none: masked_lm.score(df, masked_lm.train(df)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_for_each_row(name, odd, empty):
    ids = lambda rows: sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows)
    assert ids(OPERATORS[name](odd, False).collect()) == ids(odd.collect())
    assert OPERATORS[name](empty, True).collect() == []


def test_leaks_on_odd_rows(spark, odd, empty):
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(odd, benchmark(spark)).collect()}
    assert found == {(1, 1), (None, 1), (6, 3)}
    assert decontamination.leaks(odd, benchmark(spark, True)).collect() == []
    assert decontamination.leaks(empty, benchmark(spark)).collect() == []


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    labels(spark).write.parquet(f"{path}/labels.parquet")
    benchmark(spark).write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_odd_rows(spark, odd, empty, folder, name, stage):
    got = stage(spark, odd, folder)
    rows = got.collect()
    if name == "near_duplicates":
        # of the repeated row and its copy without id one stays; both texts under one id do
        assert sorted(r["doc_id"] or 0 for r in rows) == [1, 2, 3, 4, 5, 5, 6]
    if name == "benchmark_leaks":
        assert sorted(r["doc_id"] for r in rows) == [2, 3, 4, 5, 5]  # the leaking row without id goes too
    if name == "secrets":
        assert len(rows) == odd.count() and any("*" * 16 in (r["text"] or "") for r in rows)
    if name != "tokens":
        assert got.columns == list(corpus_pipeline.COLUMNS)
    assert stage(spark, empty, folder).collect() == []


def test_stages_against_brute_force(spark, documents):
    """Each stage over the small tables, one after the other, against plain Python."""
    from test_text_operators import brute_groups, leaked

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.quality(spark, docs, SF)
    marks = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert sum((i in ids) == bool(q) for i, q in marks.items()) >= 0.8 * len(marks)  # about fifty trusted rows
    rows = [(i, t) for i, t in documents if i in ids]
    groups = brute_groups(rows)
    once = corpus_pipeline.near_duplicates(spark, kept, SF)
    assert {r["doc_id"] for r in once.select("doc_id").collect()} == {i for i, g in groups.items() if i == g}
    left = corpus_pipeline.benchmark_leaks(spark, once, SF)
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()]
    want = {i for i, t in rows if groups[i] == i and not any(leaked(t, b) for _, b in items)}
    assert {r["doc_id"] for r in left.select("doc_id").collect()} == want
    masked = {r["doc_id"]: r["text"] for r in corpus_pipeline.secrets(spark, left, SF).collect()}
    assert set(masked) == want and all(len(masked[i]) == len(t) for i, t in rows if i in want)
    assert corpus_pipeline.tokens(spark, left, SF).count() == len(want)


def test_operators_need_no_python_where_native(spark, monkeypatch):
    """The native queries have no Python in their plans."""
    from fieldbook.llm.queries import QUERIES

    for name in ("op1_imatch", "op2_secret_scan"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow")), name


def test_no_machine_local_folder(spark):
    assert os.path.isdir(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
