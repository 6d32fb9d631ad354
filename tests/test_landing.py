from pyspark.sql import functions as F

from fieldbook.sources import landing


def test_lines_of_split_files_are_numbered_in_order(spark, tmp_path):
    """Files cut into many splits, blank lines between documents: numbers follow the lines, and no text is shuffled."""
    want = {}
    for name, n in (("a", 700), ("b", 1), ("c", 90)):
        lines = [f'{{"county": "{name}", "chunk_index": {i}, "x": "{"y" * (i % 50)}"}}' for i in range(n)]
        (tmp_path / f"{name}.json").write_text("".join(line + "\n" + "  \n" * (i % 3) for i, line in enumerate(lines)))
        want |= {(name, i): i + 1 for i in range(n)}
    (tmp_path / "empty.json").write_text("\n\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        docs = landing.scan_documents(spark, str(tmp_path))
        assert docs.select(F.input_file_block_start()).distinct().count() > 5
        got = {(r["county"], r["chunk_index"]): r["file_row_number"] for r in docs.collect()}
        plan = docs._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == want
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan and "Sort" not in plan
