"""Curated merge straight from raw documents, and stored station assignments."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.operators.climate import latest_climate
from fieldbook.operators.merge import upsert
from fieldbook.operators.spatial import nearest
from fieldbook.operators.staging import clean_columns, extract_fields, flatten_parcels, recent


def merge_source(raw: DataFrame, as_of: dt.datetime, days: int | None = 1, first_only: bool = False) -> DataFrame:
    """Distinct parcels of recent documents; ``first_only`` takes just the first parcel of each."""
    return _versions(raw, as_of, days, first_only).distinct()


def _versions(raw: DataFrame, as_of: dt.datetime, days: int | None, first_only: bool) -> DataFrame:
    rows = flatten_parcels(raw if days is None else recent(raw, as_of, days))
    if first_only:
        rows = rows.where("parcel_index_in_chunk = 0")
    typed = clean_columns(extract_fields(rows).where(F.col("parcel_id").isNotNull()))
    drop = ["file_name", "file_row_number", "ingestion_type", "county", "chunk_index", "parcel_count", "parcel_index_in_chunk"]
    return typed.drop(*drop)


def curated_merge(target: DataFrame, raw: DataFrame, as_of: dt.datetime, days: int | None = 1, first_only: bool = False) -> DataFrame:
    """New state of the curated table: matched parcels are updated and stamped, others inserted.

    Several versions of a parcel in one run compete by ingestion time, then by their remaining columns. That order covers every
    column, so it collapses repeated versions too, and they need no shuffle of their own.
    """
    source = _versions(raw, as_of, days, first_only)
    rest = [c for c in source.columns if c not in ("parcel_id", "ingestion_timestamp")]
    stamped = source.withColumn("updated_at", F.lit(as_of))
    return upsert(target, stamped, ["parcel_id"], newest=["ingestion_timestamp", *rest])


def assign_stations(parcels: DataFrame, stations: DataFrame, climate: DataFrame) -> DataFrame:
    """Each located parcel with its nearest station and that station's newest climate year."""
    near = nearest(parcels, stations, "parcel_id", "station_id")
    return near.join(latest_climate(climate), "station_id", "left")


def map_overlays(parcels: DataFrame, overlays: dict[str, DataFrame], key: str = "parcel_id") -> DataFrame:
    """One nested record per parcel: per overlay table an array of all its rows for the parcel, ordered, empty where it has none."""
    out = parcels
    for name, rows in overlays.items():
        fields = [c for c in rows.columns if c != key]
        every = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(name))
        none = F.array().cast(every.schema[name].dataType)
        out = out.join(every, key, "left").withColumn(name, F.coalesce(name, none))
    return out
