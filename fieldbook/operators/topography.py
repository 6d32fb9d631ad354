"""Elevation points per parcel: summaries, bands, documents, terrain classes, best raster product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.functions.values import SQUARE_FEET_PER_ACRE, first_match
from fieldbook.operators.quantiles import with_quantiles
from fieldbook.operators.ranking import global_rank

# Priority of raster resolutions, best first; unknown ones come last.
RESOLUTION_PRIORITY = {
    "1 meter": 1, "3 meter": 2, "10 meter": 3, "30 meter": 4, "1/3 arc-second": 2, "1 arc-second": 4,
}
PRODUCT_WORDS = "dem|elevation|3dep"
MAX_PRODUCT_BYTES = 500 * 1024 * 1024


def parcel_summary(points: DataFrame) -> DataFrame:
    """Statistics per parcel. The minimum is of the mean elevation, the maximum of the maximum."""
    measured = points.where(F.col("mean_elevation_ft").isNotNull())
    return with_quantiles(
        measured,
        ["parcel_id"],
        "mean_elevation_ft",
        {"elevation_median": 0.5},
        [
            F.min("mean_elevation_ft").alias("elevation_min"),
            F.max("max_elevation_ft").alias("elevation_max"),
            F.avg("mean_elevation_ft").alias("elevation_mean"),
            F.stddev_samp("mean_elevation_ft").alias("elevation_std"),
            F.max("elevation_units").alias("elevation_units"),
            F.count(F.lit(1)).alias("elevation_points_count"),
            F.max("processing_method").alias("processing_method"),
            F.avg("slope_degrees").alias("slope_degrees"),
        ],
    )


def elevation_statistics(summary: DataFrame) -> DataFrame:
    mean, slope = F.col("elevation_mean"), F.col("slope_degrees")
    return summary.agg(
        F.count(F.lit(1)).alias("total_parcels"),
        F.avg(mean).alias("avg_elevation"),
        F.min("elevation_min").alias("overall_min_elevation"),
        F.max("elevation_max").alias("overall_max_elevation"),
        F.stddev_samp(mean).alias("elevation_std_dev"),
        F.count_if(mean < 100).alias("low_elevation_parcels"),
        F.count_if(mean.between(100, 500)).alias("mid_elevation_parcels"),
        F.count_if(mean > 500).alias("high_elevation_parcels"),
        F.avg(slope).alias("avg_slope"),
        F.count_if(slope > 15).alias("steep_slope_parcels"),
    )


def detail_view(points: DataFrame, summary: DataFrame) -> DataFrame:
    extra = summary.select(
        "parcel_id", F.col("elevation_min").alias("summary_min"), F.col("elevation_max").alias("summary_max"),
        F.col("elevation_mean").alias("summary_mean"),
    )
    return points.join(extra, "parcel_id", "left")


def parcel_documents(points: DataFrame, order: list[Column], per_document: int = 1000) -> DataFrame:
    """JSON documents of a parcel's points, ``per_document`` points each, numbered from 0.

    A parcel with many points is written as several numbered documents, so that no task has to hold
    all points of one parcel.
    """
    return _point_lists(points, order, per_document).select(
        "parcel_id", "part", F.size("elevation_points").alias("points"),
        F.to_json(F.struct("parcel_id", "part", "elevation_points")).alias("document"),
    )


def _point_lists(points: DataFrame, order: list[Column], per_document: int) -> DataFrame:
    """``elevation_points`` by parcel and ``part``, in order."""
    ranked = global_rank(points, order, "position", ["parcel_id"])
    fields = [c for c in points.columns if c != "parcel_id"]
    chunk = F.floor((F.col("position") - 1) / per_document).alias("part")
    return ranked.groupBy("parcel_id", chunk).agg(
        F.array_sort(F.collect_list(F.struct("position", *fields))).alias("elevation_points")
    )


def whole_documents(points: DataFrame, terrain: DataFrame, order: list[Column], per_document: int = 1000) -> DataFrame:
    """Documents of a parcel's points, the first of which also carries the parcel's summary and terrain analysis.

    ``terrain`` has one row for each parcel; its other columns make up the analysis.
    """
    fields = [c for c in terrain.columns if c != "parcel_id"]
    summary = parcel_summary(points)
    summary = summary.select("parcel_id", F.struct(*[c for c in summary.columns if c != "parcel_id"]).alias("summary"))
    about = summary.join(terrain.select("parcel_id", F.struct(*fields).alias("terrain_analysis")), "parcel_id", "left")
    # joined by the parcel alone, as the points already lie by parcel: no document is shuffled
    first = F.col("part") == 0
    lists = _point_lists(points, order, per_document).join(about, "parcel_id", "left")
    lists = lists.withColumns({"summary": F.when(first, F.col("summary")), "terrain_analysis": F.when(first, F.col("terrain_analysis"))})
    return lists.select(
        "parcel_id", "part", F.size("elevation_points").alias("points"),
        F.to_json(F.struct("parcel_id", "part", "summary", "elevation_points", "terrain_analysis")).alias("document"),
    )


def terrain_class(slope: Column) -> Column:
    return first_match(
        [
            (slope < 2, "flat_terrain"), (slope < 8, "gently_sloping"), (slope < 15, "moderately_sloping"),
            (slope < 25, "steep_terrain"),
        ],
        "very_steep_terrain",
    )


def terrain_columns(lowest: Column, highest: Column, acres: Column) -> dict[str, Column]:
    """Elevation range, slope percent over the side of a square parcel (capped at 100), and its class."""
    span = highest - lowest
    slope = F.when(acres > 0, F.least(F.lit(100.0), span / F.sqrt(acres * SQUARE_FEET_PER_ACRE) * 100)).otherwise(0.0)
    return {
        "elevation_variance_ft": span,
        "slope_percent": F.round(slope, 2),
        "terrain_analysis": terrain_class(slope),
    }


def best_product(products: DataFrame, key: str) -> DataFrame:
    """Per area, the usable elevation product with the best resolution; the first listed wins ties."""
    priority = F.lit(5)
    for name, rank in RESOLUTION_PRIORITY.items():
        priority = F.when(F.lower("resolution") == name, rank).otherwise(priority)
    usable = products.where(F.lower("title").rlike(PRODUCT_WORDS) & (F.col("size_bytes") <= MAX_PRODUCT_BYTES))
    best = F.min_by(F.struct("title", "resolution", "size_bytes"), F.struct(priority, F.col("position")))
    return usable.groupBy(key).agg(best.alias("b")).select(key, "b.*")


def checked_coordinates(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Numeric coordinates and a validity flag; unparsable text counts as invalid."""
    y, x = F.col(lat).try_cast("double"), F.col(lon).try_cast("double")
    ok = F.coalesce(y.between(-90, 90) & x.between(-180, 180), F.lit(False))
    return df.withColumns({"_ok": ok, lat: F.when(ok, y), lon: F.when(ok, x)}).withColumnRenamed("_ok", "is_valid")
