"""Tables of the session catalog: created from queries, attached, listed, described and checked."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def create_table_as(df: DataFrame, name: str, folder: str) -> DataFrame:
    """A catalog table with the rows of a query, stored in ``folder``; fails when the table exists."""
    df.write.format("parquet").option("path", folder).mode("errorifexists").saveAsTable(name)
    return df.sparkSession.table(name)


def attach_table(spark: SparkSession, name: str, path: str, kind: str = "parquet") -> DataFrame:
    """Names files that are already there; an attached table of the same name is left as it is."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source=kind)
    return spark.table(name)


def _sizes(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """Row count of each table, as one job."""
    out = None
    for name in names:
        rows = spark.table(name).agg(F.lit(name.lower()).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        out = rows if out is None else out.unionByName(rows)
    return spark.createDataFrame([], "table_name string, row_count bigint") if out is None else out


def list_tables(spark: SparkSession, pattern: str | None = None) -> DataFrame:
    """Tables of the current database by name: kind, number of columns, rows."""
    found = [t for t in spark.catalog.listTables(pattern=pattern) if not t.isTemporary]
    rows = [(t.name.lower(), t.tableType, len(spark.catalog.listColumns(t.name))) for t in found]
    listing = spark.createDataFrame(rows, "table_name string, table_type string, n_columns int")
    return listing.join(_sizes(spark, [t.name for t in found]), "table_name")


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    """Columns of a table in order, with its row count."""
    if not spark.catalog.tableExists(name):
        raise FileNotFoundError(name)
    columns = [(i, c.name, c.dataType, c.nullable) for i, c in enumerate(spark.catalog.listColumns(name))]
    listing = spark.createDataFrame(columns, "position int, column_name string, data_type string, nullable boolean")
    return listing.withColumn("row_count", spark.table(name).agg(F.count(F.lit(1)).alias("n")).scalar())


def check_tables(spark: SparkSession, expected: dict[str, Sequence[str]]) -> DataFrame:
    """One row for each expected table: does it exist, has it rows, which required columns lack, and the overall status."""
    there = [n for n in expected if spark.catalog.tableExists(n)]
    rows = []
    for name, required in expected.items():
        have = {c.name.lower() for c in spark.catalog.listColumns(name)} if name in there else set()
        rows.append((name.lower(), name in there, ",".join(sorted({c.lower() for c in required} - have))))
    checked = spark.createDataFrame(rows, "table_name string, table_exists boolean, missing_columns string")
    out = checked.join(_sizes(spark, there), "table_name", "left").withColumn("row_count", F.coalesce("row_count", F.lit(0)))
    passed = F.col("table_exists") & (F.col("row_count") > 0) & (F.col("missing_columns") == "")
    return out.withColumns({"has_rows": F.col("row_count") > 0, "status": F.when(passed, "pass").otherwise("fail")})
