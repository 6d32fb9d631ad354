"""Tables kept as Parquet folders: merges that rewrite only what they touch, loads, exports, chunks, run state, names and types.

A merged table is partitioned by a hash of its keys. A merge reads and overwrites the partitions that hold changed keys, by the
dynamic overwrite of Spark's file writer; the others stay as they are. Repeating a merge gives the same table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fieldbook.functions.values import surrogate_key
from fieldbook.operators.merge import upsert
from fieldbook.operators.ranking import global_rank
from fieldbook.session import cut_lineage

#: Partitions of a merged table; the same for its whole life.
BUCKETS, BUCKET = 64, "_bucket"


def read_table(spark: SparkSession, root: str) -> DataFrame:
    """A merged table as it is now."""
    return spark.read.parquet(root).drop(BUCKET)


def _stored(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.parquet(root)
    except AnalysisException:  # no such folder yet
        return None


def _write(df: DataFrame, root: str, bucket: Column) -> None:
    tagged = df.withColumn(BUCKET, bucket).repartition(BUCKET)
    tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(root)


def merge_into(changes: DataFrame, root: str, keys: Sequence[str], newest: Sequence[str], late: bool = False) -> None:
    """Merge ``changes`` into the table at ``root``, which the first call creates.

    The newest change of a key wins; with ``late`` it must also be newer than the stored row, so changes may arrive in any
    order. What a touched partition will hold is put down in the shared folder before the partition is overwritten.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")
    table = _stored(changes.sparkSession, root)
    if table is None:
        _write(upsert(changes.limit(0), changes, keys, newest=newest), root, bucket)
        return
    touched = [r[0] for r in changes.select(bucket.alias("b")).distinct().collect()]  # at most BUCKETS numbers
    old = table.where(F.col(BUCKET).isin(touched)).drop(BUCKET)
    source = old.join(changes.select(*keys).distinct(), list(keys), "left_semi").select(*changes.columns).unionByName(changes) if late else changes
    _write(cut_lineage(upsert(old, source, keys, newest=newest)), root, bucket)


def load_frame(df: DataFrame, path: str, if_exists: str = "append") -> int:
    """Append to, replace, or refuse an existing table folder. Returns the rows written."""
    modes = {"append": "append", "replace": "overwrite", "fail": "errorifexists"}
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(modes[if_exists]).parquet(path)
    return seen.get["rows"]


def append_raw(df: DataFrame, path: str) -> int:
    """Append raw documents; counties are upper case, a missing one reads UNKNOWN."""
    county = F.upper(F.coalesce(F.nullif(F.trim("county"), F.lit("")), F.lit("UNKNOWN")))
    return load_frame(df.withColumn("county", county), path)


def export(df: DataFrame, path: str, kind: str = "json") -> None:
    """Result files for other tools, one part per task."""
    writer = df.write.mode("overwrite")
    if kind == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.json(path)


def chunk_documents(parcels: DataFrame, county: str, order: list[str], size: int = 500) -> DataFrame:
    """Fixed-size JSON documents per county, each with its index and the number of chunks.

    Positions come from the distributed rank, so even a county with most of the rows is cut into
    chunks without passing through one task.
    """
    body = [c for c in parcels.columns if c != county]
    ranked = global_rank(parcels, [F.col(c) for c in order], "_pos", [county])
    chunk = F.floor((F.col("_pos") - 1) / size).alias("chunk_index")
    lists = ranked.groupBy(county, chunk).agg(F.array_sort(F.collect_list(F.struct("_pos", *body))).alias("_list"))
    totals = parcels.groupBy(county).agg(F.ceil(F.count(F.lit(1)) / size).alias("total_chunks"))
    out = lists.join(totals, county).select(
        county, "chunk_index", "total_chunks", F.size("_list").alias("parcel_count"),
        F.transform("_list", lambda p: p.dropFields("_pos")).alias("parcels"),
    )
    name = F.format_string("%s/chunk_%04d.json", F.col(county), F.col("chunk_index"))
    return out.withColumns({"path": name, "document": F.to_json(F.struct(county, "chunk_index", "total_chunks", "parcel_count", "parcels"))}).drop("parcels")


def batch_plan(parcels: DataFrame, state: str, key: str, size: int = 100) -> DataFrame:
    """Numbered batches of keys per state, with the number of batches."""
    ranked = global_rank(parcels.select(state, key), [F.col(key)], "_pos", [state])
    batch = F.ceil(F.col("_pos") / size).alias("batch_number")
    lists = ranked.groupBy(state, batch).agg(F.sort_array(F.collect_list(key)).alias("keys"))
    totals = parcels.groupBy(state).agg(F.ceil(F.count(F.lit(1)) / size).alias("total_batches"))
    return lists.join(totals, state).withColumn("batch_size", F.size("keys"))


# Run state --------------------------------------------------------------------------------------


def last_successful_run(log: DataFrame, job: str = "job", end: str = "end_time", status: str = "status") -> DataFrame:
    return log.groupBy(job).agg(
        F.max(end).alias("last_run"), F.max(F.when(F.col(status) == "completed", F.col(end))).alias("last_success")
    )


def job_progress(batches: DataFrame, as_of, job: str = "job_id") -> DataFrame:
    """Processed and failed counts, hourly rate and estimated completion per job.

    ``batches`` has one row per finished batch: job, total, processed, failed, started_at, finished_at.
    """
    at = F.lit(as_of).cast("timestamp")
    out = batches.groupBy(job).agg(
        F.max("total").alias("total"), F.sum("processed").alias("processed"), F.sum("failed").alias("failed"),
        F.min("started_at").alias("started_at"), F.max("finished_at").alias("updated_at"),
    )
    hours = (F.unix_micros(F.col("updated_at").cast("timestamp")) - F.unix_micros(F.col("started_at").cast("timestamp"))) / 3.6e9
    out = out.withColumn("rate_per_hour", F.when(hours > 0, F.col("processed") / hours))
    left = F.greatest(F.col("total") - F.col("processed"), F.lit(0))
    eta = F.when(
        F.col("rate_per_hour") > 0, F.timestamp_micros((F.unix_micros(at) + left / F.col("rate_per_hour") * 3.6e9).cast("bigint"))
    )
    status = F.when(left == 0, "completed").when(F.col("processed") > 0, "running").otherwise("pending")
    done = F.when(left == 0, F.col("updated_at").cast("timestamp"))
    return out.withColumns({"remaining": left, "estimated_completion": eta, "completed_at": done, "status": status})


def progress_listing(progress: DataFrame, job: str | None = None, status: str | None = None, key: str = "job_id") -> DataFrame:
    """Jobs, newest change first, of one name or in one state where given."""
    rows = progress.where(F.col(key) == job) if job is not None else progress
    rows = rows.where(F.col("status") == status) if status is not None else rows
    return rows.orderBy(F.desc("updated_at"), key)


# Names and types --------------------------------------------------------------------------------


def table_ddl(df: DataFrame, name: str) -> str:
    """CREATE TABLE text from column names and types."""
    body = ",\n  ".join(f"`{f.name}` {column_type(f.name, f.dataType.simpleString())}" for f in df.schema.fields)
    return f"CREATE TABLE IF NOT EXISTS {name} (\n  {body}\n) USING parquet"


def column_type(name: str, kind: str) -> str:
    """Type of a column by its name first, then by its data type."""
    words = set(name.lower().split("_"))
    if name.lower() == "id" or "id" in words:
        return "STRING"
    if words & {"date", "time", "createdate", "closedate", "lastmodifieddate"}:
        return "TIMESTAMP"
    if name.lower() in ("email", "phone"):
        return "STRING"
    return {"int": "BIGINT", "float": "DOUBLE"}.get(kind, kind.upper())


def with_row_key(df: DataFrame, *cols: str) -> DataFrame:
    """A content key in place of an auto-increment."""
    return df.withColumn("row_key", surrogate_key(*cols))
