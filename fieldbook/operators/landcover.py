"""Land-cover classes per parcel: statistics, summaries, views and documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.functions.values import SQUARE_FEET_PER_ACRE, first_match
from fieldbook.operators.dimensions import land_cover_classes


def with_class(detail: DataFrame) -> DataFrame:
    """Attach class columns; codes outside the dimension drop out. The 20-row dimension is broadcast."""
    return detail.join(F.broadcast(land_cover_classes(detail.sparkSession)), "nlcd_code")


def class_statistics(features: DataFrame, keys: tuple[str, ...] = ("parcel_id",)) -> DataFrame:
    """Area, count, share and dominance per class of a parcel.

    Aggregating to (parcel, class) first leaves at most one row per known class and parcel, so the
    window that follows only ever sees small groups, whatever the number of features.
    """
    carried = [c for c in ("nlcd_year", "processing_method") if c in features.columns]
    per_class = features.groupBy(*keys, "nlcd_code").agg(
        F.sum("area").alias("class_area"), F.count(F.lit(1)).alias("feature_count"),
        *[F.max(c).alias(c) for c in carried],
    )
    whole = Window.partitionBy(*keys)
    best = whole.orderBy(F.desc("class_area"), "nlcd_code")
    return (
        per_class.withColumn("total_area", F.sum("class_area").over(whole))
        .withColumn("coverage_percentage", F.when(F.col("total_area") > 0, F.col("class_area") / F.col("total_area") * 100))
        .withColumn("is_dominant_class", F.row_number().over(best) == 1)
    )


def detail_rows(stats: DataFrame, acres: Column, minimum: float = 0.1) -> DataFrame:
    """Rows worth storing: classes above ``minimum`` percent, with their area in square feet."""
    return stats.where(F.col("coverage_percentage") > minimum).withColumn(
        "coverage_area_sqft", acres * SQUARE_FEET_PER_ACRE * F.col("coverage_percentage") / 100
    )


def parcel_summary(detail: DataFrame, dominant_only: bool = False) -> DataFrame:
    """One row per parcel: dominant class, class count, shares and flags.

    ``dominant_only`` restricts the summary to rows of the dominant class, as the stored procedure
    this mirrors effectively did; the default covers all classes.
    """
    rows = with_class(detail)
    dominant = F.max_by(
        F.struct("nlcd_code", "class_name", "coverage_percentage"),
        F.struct(F.col("coverage_percentage"), -F.col("nlcd_code")),
    ).alias("_dominant")
    if dominant_only:
        top = rows.groupBy("parcel_id").agg(dominant).select("parcel_id", F.col("_dominant.nlcd_code").alias("nlcd_code"))
        rows = rows.join(top, ["parcel_id", "nlcd_code"])
    share = F.col("coverage_percentage")

    def total(flag):
        return F.sum(F.when(flag, share).otherwise(0.0))

    developed = F.col("class_category") == "Developed"
    out = rows.groupBy("parcel_id").agg(
        dominant,
        F.max("nlcd_year").alias("nlcd_year"),
        F.count(F.lit(1)).alias("total_classes_count"),
        F.bool_or("is_agricultural").alias("is_agricultural"),
        F.bool_or("is_natural").alias("is_natural"),
        F.bool_or(developed).alias("is_developed"),
        total(F.col("is_agricultural")).alias("agricultural_percentage"),
        total(F.col("is_natural")).alias("natural_percentage"),
        total(developed).alias("developed_percentage"),
        F.max("processing_method").alias("processing_method"),
        F.sum("coverage_area_sqft").alias("total_area_sqft"),
    )
    return out.select(
        "parcel_id",
        F.col("_dominant.nlcd_code").alias("dominant_nlcd_code"),
        F.col("_dominant.class_name").alias("dominant_class_name"),
        F.col("_dominant.coverage_percentage").alias("dominant_class_percentage"),
        *[c for c in out.columns if c not in ("parcel_id", "_dominant")],
    )


def agricultural_parcels(summary: DataFrame) -> DataFrame:
    return summary.where("is_agricultural").select(
        "parcel_id", "dominant_class_name", "dominant_class_percentage", "agricultural_percentage", "nlcd_year"
    )


def parcel_documents(detail: DataFrame) -> DataFrame:
    """One JSON document per parcel: the summary and its classes, largest share first.

    ``detail`` holds one row per parcel and class, so the collected list is bounded by the dimension.
    """
    named = with_class(detail)
    entry = F.struct(
        (-F.col("coverage_percentage")).alias("order_key"), "nlcd_code", "class_name", "class_category",
        "coverage_percentage", "coverage_area_sqft", F.col("is_dominant_class").alias("is_dominant"),
        "is_agricultural", "is_natural", F.col("class_color").alias("color"),
    )
    classes = named.groupBy("parcel_id").agg(F.array_sort(F.collect_list(entry)).alias("classes"))
    classes = classes.withColumn("classes", F.transform("classes", lambda e: e.dropFields("order_key")))
    summary = parcel_summary(detail).select(
        "parcel_id",
        F.struct(
            F.col("dominant_class_name").alias("dominant_class"),
            F.col("dominant_class_percentage").alias("dominant_percentage"),
            "is_agricultural", "is_natural", "is_developed", "agricultural_percentage", "natural_percentage",
            "developed_percentage", "nlcd_year",
        ).alias("summary"),
    )
    return summary.join(classes, "parcel_id").select(
        "parcel_id", F.to_json(F.struct("parcel_id", "summary", "classes")).alias("document")
    )


def processing_method(has_geometry: Column, acres: Column, lat: Column, lon: Column) -> Column:
    """polygon for parcels with a boundary of at least one acre, else point; null without either."""
    return first_match([(has_geometry & (acres >= 1), "polygon"), (lat.isNotNull() & lon.isNotNull(), "point_sample")])


def method_errors(method: Column) -> Column:
    return F.when(method.isNull(), F.lit("No coordinates available for parcel"))


def integrity_counts(detail: DataFrame) -> DataFrame:
    """Rows with a share outside 0..100, and rows whose code the dimension does not know."""
    known = F.broadcast(land_cover_classes(detail.sparkSession).select("nlcd_code", F.lit(True).alias("known")))
    share = F.col("coverage_percentage")
    return detail.join(known, "nlcd_code", "left").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(share.isNull() | (share < 0) | (share > 100)).alias("bad_percentage"),
        F.count_if(F.col("known").isNull()).alias("unknown_code"),
    )
