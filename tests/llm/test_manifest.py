"""Manifest trees against a plain recursive version, over several shapes of trees."""

import hashlib
import zlib

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fieldbook.llm import merkle
from fieldbook.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
h = lambda s: hashlib.sha256(s.encode()).hexdigest()
EMPTY = hashlib.sha256(b"").hexdigest()


def plain_field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain_tree(leaves, fanout=2):
    """Root, and for each leaf the (left, right) siblings level by level."""
    ways, places = [[] for _ in leaves], list(range(len(leaves)))
    while len(leaves) > 1:
        runs = [leaves[i : i + fanout] for i in range(0, len(leaves), fanout)]
        for n, p in enumerate(places):
            run, d = runs[p // fanout], p % fanout
            ways[n].append(("".join(run[:d]), "".join(run[d + 1 :])))
            places[n] = p // fanout
        leaves = [h("".join(run)) for run in runs]
    return leaves[0], ways


def folded(digest, way):
    for a, b in way:
        digest = h(a + digest + b)
    return digest


def plain_manifest(rows, fanout=2):
    """rows: (group, id, leaf, claimed) -> sorted (id, leaf, subroot, root, proof hash, folded)."""
    trees = {}
    for g, i, leaf, claimed in rows:
        trees.setdefault(g, []).append((i is not None, i or 0, leaf, claimed, i))
    groups = sorted(trees, key=lambda g: (g is not None, (g or "").encode()))
    roots = {}
    for g in groups:
        trees[g].sort(key=lambda r: r[:3])
        roots[g] = plain_tree([r[2] for r in trees[g]], fanout)
    root, ups = plain_tree([roots[g][0] for g in groups], fanout)
    out = []
    for g, up in zip(groups, ups):
        for (_, _, leaf, claimed, i), way in zip(trees[g], roots[g][1]):
            out.append((str(i), leaf, roots[g][0], root, h("".join(a + b for a, b in way + up)), folded(claimed, way + up)))
    return sorted(out)


def manifest_rows(df, fanout=2):
    out = merkle.manifest(df, "g", ["id"], "leaf", "claimed", ["id"], fanout)
    x = lambda c: merkle.hexed(F.col(c))
    rows = out.select("id", x("leaf"), x("subroot"), x("root"), F.sha2(x("proof").cast("binary"), 256), x("folded_root")).collect()
    return sorted((str(r[0]), *r[1:]) for r in rows)


@pytest.mark.parametrize("fanout,block,sizes", [
    (2, 4096, {"a": 5, "b": 1, None: 3}),
    (2, 4, {"a": 23, "b": 1, "c": 4, "é": 5, None: 9, "": 16, "z": 17}),
    (3, 3, {"a": 28, "b": 10, "c": 82}),
    (2, 2, {"only": 37}),
    (4, 16, {f"g{i}": i % 5 + 1 for i in range(70)}),
])
def test_shapes(spark, monkeypatch, fanout, block, sizes):
    """Trees of one block and of many, whole and broken last subtrees, many groups, altered rows."""
    monkeypatch.setattr(merkle, "BLOCK_LEAVES", block)
    rows = [(g, n * 1000 + i, h(f"{g}{i}"), h(f"{g}{i}" + "x" * (i % 3 == 0))) for n, (g, size) in enumerate(sizes.items()) for i in range(size)]
    df = spark.createDataFrame(rows, "g string, id bigint, leaf string, claimed string")
    df = df.withColumn("leaf", F.unhex("leaf")).withColumn("claimed", F.unhex("claimed"))
    got = manifest_rows(df, fanout)
    assert got == plain_manifest(rows, fanout)
    assert all((folded == root) == (int(i) % 1000 % 3 != 0) for i, _, _, root, _, folded in got)


def test_odd_rows(spark, odd, empty):
    """Null ids and groups, repeated rows and columns of other operators; an empty table has no rows."""
    leaf = merkle.digest_of([merkle.field(F.col("doc_id"), False), merkle.field(F.col("text"))])
    named = lambda df: df.select(F.col("lang").alias("g"), F.col("doc_id").alias("id"), leaf.alias("leaf"), leaf.alias("claimed"), "key", "found")
    rows = [(r["lang"], r["doc_id"], h(plain_field(r["doc_id"]) + plain_field(r["text"]))) for r in odd.collect()]
    assert manifest_rows(named(odd)) == plain_manifest([(*r, r[2]) for r in rows])
    assert manifest_rows(named(empty)) == []


def test_one_hot_row(spark):
    """Equal rows spread over the ranges, and every one is a leaf."""
    df = spark.range(9000).selectExpr("'x' AS g", "IF(id % 3 = 0, 7L, id) AS id")
    df = df.withColumn("leaf", merkle.digest_of([merkle.field(F.col("id"), False)])).withColumn("claimed", F.col("leaf"))
    rows = [("x", r["id"], r["leaf"].hex(), r["leaf"].hex()) for r in df.collect()]
    assert manifest_rows(df) == plain_manifest(rows)


def test_query(spark):
    rows = []
    for r in pq.read_table(f"{SF}/documents.parquet").to_pylist():
        content = [r[c] for c in ("doc_id", "source", "lang", "n_chars", "text")]
        leaf = h("".join(map(plain_field, content)))
        if zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0:
            content[3] += 1
        rows.append((r["lang"], r["doc_id"], leaf, h("".join(map(plain_field, content)))))
    got = QUERIES["op13_merkle_manifest"](spark, SF).collect()
    names = ("leaf", "subroot", "root", "proof_sha256", "folded_root")
    assert sorted((str(r["doc_id"]), *[r[n] for n in names]) for r in got) == plain_manifest(rows)
    assert all(r["verified"] == (r["folded_root"] == r["root"]) for r in got)
