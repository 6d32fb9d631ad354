"""Which parcels still need work: freshness, missing history, missing enrichments."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def result_status(
    wanted: DataFrame, results: DataFrame, key: str, ts: str, as_of: dt.datetime, max_age_days: int,
    force_refresh: bool = False,
) -> DataFrame:
    """Every wanted row with ``status`` missing, stale or fresh."""
    newest = results.groupBy(key).agg(F.max(ts).alias("last_processed_at"))
    joined = wanted.join(newest, key, "left")
    cutoff = F.lit(as_of - dt.timedelta(days=max_age_days))
    at = F.col("last_processed_at")
    fresh = F.lit(False) if force_refresh else at >= cutoff
    return joined.withColumn("status", F.when(at.isNull(), "missing").when(fresh, "fresh").otherwise("stale"))


def needs_processing(
    wanted: DataFrame, results: DataFrame, key: str, ts: str, as_of: dt.datetime, max_age_days: int,
    force_refresh: bool = False,
) -> DataFrame:
    """Rows with no result, or only results older than the limit."""
    if force_refresh:
        return wanted
    fresh = results.where(F.col(ts) >= F.lit(as_of - dt.timedelta(days=max_age_days))).select(key)
    return wanted.join(fresh, key, "left_anti")


def eligible(parcels: DataFrame, states: list[str] | None = None) -> DataFrame:
    """Rows with coordinates, in one of the states when given."""
    out = parcels.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return out.where(F.col("state_code").isin(states)) if states else out


def without_history(parcels: DataFrame, history: DataFrame, states: list[str] | None = None) -> DataFrame:
    return eligible(parcels, states).join(history.select("parcel_id"), "parcel_id", "left_anti")


def enrichment_gaps(
    parcels: DataFrame, sources: dict[str, DataFrame], since: Column | dt.datetime, created: str = "created_at",
    limit: int | None = None,
) -> DataFrame:
    """Recent, located parcels that lack at least one enrichment, with one flag per source.

    Each source is reduced to its distinct keys first, so a parcel with many detail rows neither
    multiplies the result nor makes its key hot. ``limit`` is the size of a work queue, newest first.
    """
    bound = since if isinstance(since, Column) else F.lit(since)
    out = parcels.where(F.col(created) >= bound).where(
        F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    )
    missing = F.lit(False)
    for name, rows in sources.items():
        have = rows.select("parcel_id").distinct().withColumn(f"has_{name}", F.lit(True))
        out = out.join(have, "parcel_id", "left").withColumn(f"has_{name}", F.coalesce(f"has_{name}", F.lit(False)))
        missing = missing | ~F.col(f"has_{name}")
    out = out.where(missing)
    return out.orderBy(F.desc(created), "parcel_id").limit(limit) if limit else out


def parcel_years(parcels: DataFrame, first: int, last: int, out: str = "crop_year") -> DataFrame:
    """One row per parcel and year; expands within the row, without a join."""
    return parcels.withColumn(out, F.explode(F.sequence(F.lit(first), F.lit(last))))


def job_status(requests: DataFrame, status: str = "status") -> DataFrame:
    """Counts per outcome, with totals alongside."""
    s = F.col(status)
    return requests.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(s == "success").alias("successful"),
        F.count_if(s == "failed").alias("failed"),
        F.count_if(s == "skipped").alias("skipped"),
    )


def failures(requests: DataFrame, key: str, error: str, status: str = "status") -> DataFrame:
    """The failed rows with their message; kept as rows because there may be any number of them."""
    return requests.where(F.col(status) == "failed").select(key, error)
