"""Streaming jobs over files: ingest, event filter, fan-out, hourly quota, upsert, error routing, expiry.

Every job runs with the available-now trigger by default, so a scheduler can call it at fixed times;
pass another trigger to keep it running. Checkpoints and outputs live in folders the caller names.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fieldbook.functions.documents import parse_or_salvage, is_salvaged
from fieldbook.sources.tables import merge_into


def file_stream(spark: SparkSession, folder: str, schema, kind: str = "parquet", pattern: str = "*", per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.format(kind).load(folder)


def document_stream(spark: SparkSession, folder: str, pattern: str = "*.json") -> DataFrame:
    """New landed documents, one per line, with their file name."""
    lines = spark.readStream.option("pathGlobFilter", pattern).option("recursiveFileLookup", True).text(folder)
    return lines.select(F.col("_metadata.file_path").alias("file_name"), F.col("value").alias("raw_data"))


def run(df: DataFrame, start: Callable, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    writer = df.writeStream.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True}))
    return start(writer)


def append_files(df: DataFrame, path: str, checkpoint: str, **kw) -> StreamingQuery:
    """Append to a Parquet folder; each file is taken exactly once across restarts."""
    return run(df, lambda w: w.format("parquet").option("compression", "zstd").outputMode("append").start(path), checkpoint, **kw)


def wanted_events(events: DataFrame, key: str = "key", name: str = "event_name") -> DataFrame:
    """Creation events of parcel JSON files."""
    k = F.lower(F.col(key))
    return events.where(k.endswith(".json") & k.contains("parcel") & F.col(name).startswith("ObjectCreated"))


def fan_out(df: DataFrame, routes: dict[str, Column], root: str, checkpoint: str, **kw) -> StreamingQuery:
    """Write each micro-batch to every route whose condition a row meets.

    One pass: the routes of a row become a partition column. The batch number is part of the path and
    is overwritten on a retry, so a repeated batch leaves no duplicates.
    """

    def write(batch: DataFrame, number: int) -> None:
        names = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in routes.items()]))
        rows = batch.withColumn("route", F.explode(names))
        rows.write.mode("overwrite").partitionBy("route").parquet(f"{root}/batch={number}")

    return run(df, lambda w: w.foreachBatch(write).start(), checkpoint, **kw)


def hourly_quota(events: DataFrame, ts: str, key: str, limit: int = 1000, late: str = "2 hours") -> DataFrame:
    """Requests per key and hour, flagged from the limit on.

    In update mode the open hour is counted as requests arrive, so a limit acts at once; in append mode an hour comes once, when
    it is ``late`` old.
    """
    counts = events.withWatermark(ts, late).groupBy(F.window(ts, "1 hour"), key).agg(F.count(F.lit(1)).alias("requests"))
    return counts.select(F.col("window.start").alias("hour"), key, "requests", (F.col("requests") >= limit).alias("exhausted"))


def stream_upsert(changes: DataFrame, root: str, keys: Sequence[str], newest: Sequence[str], checkpoint: str, mode: str = "append", **kw) -> StreamingQuery:
    """Merge each micro-batch into a table, rewriting only partitions with changed keys; repeating a batch gives the same table.
    ``mode`` is update for running counts.

    An older change that arrives late does not replace a newer row: existing rows of the touched keys
    compete with the batch by ``newest``.
    """

    def write(batch: DataFrame, number: int) -> None:
        merge_into(batch, root, keys, newest, late=True)

    return run(changes, lambda w: w.outputMode(mode).foreachBatch(write).start(), checkpoint, **kw)


def tracked(df: DataFrame, path: str, progress: str, job: str, failed: Column, checkpoint: str, total: int | None = None, **kw) -> StreamingQuery:
    """Write each micro-batch below ``path`` and its figures below ``progress``: job, total, processed, failed, start and finish.

    Rows are counted while the batch is written. A repeated batch overwrites its own rows and figures, so counts stay right
    across restarts; ``job_progress`` adds the figures up.
    """

    def write(batch: DataFrame, number: int) -> None:
        seen, started = Observation(), dt.datetime.now(dt.timezone.utc)
        counted = batch.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(failed).alias("failed"))
        counted.write.mode("overwrite").parquet(f"{path}/batch={number}")
        got = seen.get
        row = (job, total if total is not None else got["rows"], got["rows"] - got["failed"], got["failed"], started, dt.datetime.now(dt.timezone.utc))
        figures = batch.sparkSession.createDataFrame([row], "job_id string, total bigint, processed bigint, failed bigint, started_at timestamp, finished_at timestamp")
        figures.write.mode("overwrite").parquet(f"{progress}/job={job}/batch={number}")

    return run(df, lambda w: w.foreachBatch(write).start(), checkpoint, **kw)


def route_errors(documents: DataFrame, good: str, bad: str, checkpoint: str, **kw) -> StreamingQuery:
    """Documents that parse go to one table, the others with their text to an error table."""
    marked = documents.withColumn("is_malformed", is_salvaged(parse_or_salvage(F.col("raw_data"))))

    def write(batch: DataFrame, number: int) -> None:
        # Parsed once for each table: a batch may be larger than memory, and keeping it would put all texts on disk once more.
        batch.where("NOT is_malformed").write.mode("overwrite").option("compression", "zstd").parquet(f"{good}/batch={number}")
        batch.where("is_malformed").write.mode("overwrite").option("compression", "zstd").parquet(f"{bad}/batch={number}")

    return run(marked, lambda w: w.foreachBatch(write).start(), checkpoint, **kw)


def live_entries(cache: DataFrame, as_of, expiry: str = "ttl") -> DataFrame:
    """Entries that have not expired; works on tables and on streams."""
    return cache.where(F.col(expiry) >= as_of)


def first_seen(events: DataFrame, ts: str, keys: Sequence[str], within: str) -> DataFrame:
    """Each key once within a time span, the way a cache with expiry suppresses repeats."""
    return events.withWatermark(ts, within).dropDuplicatesWithinWatermark(list(keys))
