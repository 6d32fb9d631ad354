"""Ownership of secrets over distinct texts, samples of any size, and rows that share an id."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fieldbook.llm import nnpu, secret_scan
from fieldbook.llm.common import share_drawn

LIVE, SHARED, WIDE = "token=Zx81kQ9vLm3T", "token=exampleKey1234", "token=w1d3lyC0pied99"


def test_mirrored_texts_do_not_make_examples(spark):
    """A document that a second source mirrors keeps its live secret; a value in different texts of two owners, or of three
    repositories, is an example."""
    rows = [
        (1, f"a {LIVE} b", "s1", "en"), (2, f"a {LIVE} b", "s2", "en"), (3, f"a {LIVE} b", None, None),
        (4, f"x {SHARED}", "s1", "en"), (5, f"y {SHARED}", "s2", "en"),
        (6, f"p {WIDE}", "s1", "en"), (7, f"q {WIDE}", "s1", "de"), (8, f"r {WIDE}", "s1", "fr"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    found = secret_scan.find_secrets(df, owner=F.col("source"), repository=F.concat_ws("/", "source", "lang"))
    got = {r["doc_id"]: (r["found"][0]["judged"], r["found"][0]["n_owners"], r["found"][0]["n_repositories"]) for r in found.collect()}
    assert {got[i] for i in (1, 2, 3)} == {("live", 1, 1)}
    assert {got[i] for i in (4, 5)} == {("example", 2, 2)}
    assert {got[i] for i in (6, 7, 8)} == {("example", 1, 3)}


@pytest.mark.parametrize("count", [10**5, 10**11, 10**16])
def test_shares_of_any_size(spark, count):
    """The share drawn stays right far below a millionth: of the hashes below the bound's multiple all those below it are drawn."""
    bound = 1000 / count
    hashes = [int((f * bound) * 2.0**64) - 2**63 for f in np.linspace(0.001, 1.999, 400)]
    df = spark.createDataFrame([(h,) for h in hashes], "h bigint")
    assert df.where(share_drawn(F.col("h"), 1000, count)).count() == 200
    assert df.where(share_drawn(F.col("h"), 1000, 999)).count() == 400


def test_model_does_not_depend_on_the_layout(spark, odd):
    labels = spark.createDataFrame([(i, 1) for i in range(1, 7)], "doc_id bigint, quality int")
    docs = odd.select("doc_id", "text")
    one = nnpu.train(docs.coalesce(1), labels, F.col("quality") == 1)
    other = nnpu.train(docs.repartition(5), labels, F.col("quality") == 1)
    assert all(np.array_equal(a, b) for a, b in zip(one.weights, other.weights, strict=True)) and one.prior == other.prior


def test_scores_do_not_depend_on_the_number_of_indexes(spark, monkeypatch):
    """Two thousand items in many indexes and scans against one index of all: the same pairs with the same scores."""
    from fieldbook.llm import decontamination

    rng = np.random.default_rng(3)
    words = [f"word{i}" for i in range(900)]
    items = [(i, "What is " + " ".join(rng.choice(words, 12)) + "? It is " + " ".join(rng.choice(words, 8)) + ".") for i in range(2000)]
    docs = [(i, " ".join(rng.choice(words, 150)) + " " + items[i * 7][1] + " " + " ".join(rng.choice(words, 150))) for i in range(40)] + [(99, " ".join(rng.choice(words, 400)))]
    df, benchmark = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    found = []
    for size, indexes in ((2000, 1), (150, 3)):
        monkeypatch.setattr(decontamination, "ITEMS", size)
        monkeypatch.setattr(decontamination, "INDEXES", indexes)
        found.append(sorted((r["doc_id"], r["item_id"], round(r["score"], 6)) for r in decontamination.leaks(df, benchmark).collect()))
    assert found[0] == found[1] and {(i, i * 7) for i in range(40)} <= {r[:2] for r in found[0]}


def test_stages_tell_rows_under_one_id_apart(spark, tmp_path):
    """A different text under the id of a dropped one stays, whatever stage drops."""
    words = " ".join(f"w{i}" for i in range(40))
    item = "What is the capital of the small northern country named here? It is the old harbour town."
    rows = [(1, words), (2, words + " end"), (2, "quite another text under the same id"), (3, item), (3, "a text of its own"), (None, item), (None, words)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'en' AS lang", "'s' AS source", "length(text) AS n_chars")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    once = corpus_pipeline.near_duplicates(spark, df, str(tmp_path))
    assert sorted((r["doc_id"] or 0, r["text"]) for r in once.collect()) == sorted([(1, words), (2, rows[2][1]), (3, rows[4][1]), (3, item)])
    clean = corpus_pipeline.benchmark_leaks(spark, df, str(tmp_path))
    assert sorted((r["doc_id"] or 0, r["text"]) for r in clean.collect()) == sorted([(0, words), (1, words), (2, rows[2][1]), (2, words + " end"), (3, rows[4][1])])
