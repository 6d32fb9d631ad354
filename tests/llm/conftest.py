import pyarrow.parquet as pq
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents():
    """(doc_id, text) of the small table, ascending."""
    rows = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    return sorted((r["doc_id"], r["text"] or "") for r in rows)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty texts, repeated rows, ties, a very long text, and columns with names that operators use inside."""
    long = " ".join(f"word{i % 997}" for i in range(60_000))
    rows = [
        (1, "alpha beta gamma delta epsilon zeta", "en", "s1", 35),
        (1, "alpha beta gamma delta epsilon zeta", "en", "s1", 35),
        (2, None, None, None, None),
        (3, "", "en", "s1", 0),
        (None, "alpha beta gamma delta epsilon zeta", "en", None, 35),
        (4, "   \n\t ", "en", "s2", 6),
        (5, long, "en", "s2", len(long)),
        (5, "another text under the same id, token = \"a1b2c3d4e5f6a7b8\"", "en", "s2", 60),
        (6, "x", "en", "s2", 1),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    extra = {name: "lower(lang)" for name in ("key", "score", "_row", "found", "a", "bucket", "component", "term")}
    return df.selectExpr("*", *[f"{e} AS {n}" for n, e in extra.items()])


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
