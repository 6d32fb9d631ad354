"""Crop history, county statistics and headline yields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.functions.values import first_match, statistic_value
from fieldbook.operators.dimensions import (
    FULL_COVERAGE_STATES, LIMITED_COVERAGE_STATES, MAJOR_FARM_STATES, MIXED_FARM_STATES, commodities, name_crops,
)
from fieldbook.operators.ranking import top_n


def distinct_count(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Distinct values per key in two combinable steps: distinct pairs, then a count."""
    return df.where(F.col(value).isNotNull()).select(*keys, value).distinct().groupBy(*keys).agg(
        F.count(F.lit(1)).alias(out)
    )


def history_overall(history: DataFrame) -> DataFrame:
    ok = F.col("query_success")
    out = history.agg(
        F.countDistinct("parcel_id").alias("parcels"),
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(ok).alias("successful"),
        F.count_if(~ok).alias("failed"),
        F.min("crop_year").alias("earliest_year"),
        F.max("crop_year").alias("latest_year"),
    )
    answered = F.col("successful") + F.col("failed")
    return out.withColumn("success_rate", F.when(answered > 0, F.col("successful") / answered * 100).otherwise(0.0))


def history_by(history: DataFrame, key: str) -> DataFrame:
    """Parcels, queries and success rate per year or state; a hot state is counted before it moves."""
    ok = F.col("query_success")
    return (
        history.groupBy(key)
        .agg(
            F.countDistinct("parcel_id").alias("parcels"),
            F.count(F.lit(1)).alias("total_queries"),
            F.count_if(ok).alias("successful"),
        )
        .withColumn("success_rate", F.col("successful") / F.col("total_queries") * 100)
    )


def top_categories(history: DataFrame, n: int = 10) -> DataFrame:
    named = name_crops(history.where("query_success"))
    counts = named.groupBy("crop_category").agg(
        F.count(F.lit(1)).alias("occurrences"), F.countDistinct("parcel_id").alias("parcels")
    )
    return top_n(counts, [F.desc("occurrences"), F.col("crop_category")], n)


def statistics_overall(stats: DataFrame) -> DataFrame:
    return stats.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.countDistinct(F.concat_ws("-", "state_code", "county_name")).alias("counties"),
        F.countDistinct("commodity_desc").alias("commodities"),
        F.count("value_numeric").alias("numeric_values"),
        F.min("year").alias("earliest_year"),
        F.max("year").alias("latest_year"),
    )


def statistics_by_state(stats: DataFrame) -> DataFrame:
    return stats.groupBy("state_code").agg(
        F.countDistinct("county_name").alias("counties"), F.count(F.lit(1)).alias("records"),
        F.count("value_numeric").alias("numeric_values"),
    )


def top_commodities(stats: DataFrame, n: int = 20) -> DataFrame:
    counts = stats.groupBy("commodity_desc").agg(
        F.count(F.lit(1)).alias("records"), F.countDistinct("state_code", "county_name").alias("counties"),
        F.avg("value_numeric").alias("avg_value"),
    )
    return top_n(counts, [F.desc("records"), F.col("commodity_desc")], n)


def parse_statistics(stats: DataFrame) -> DataFrame:
    return stats.withColumn("value_numeric", statistic_value(F.col("value_text")))


def headline_series(records: DataFrame, area: list[str], trailing: int = 3) -> DataFrame:
    """The newest periods of one comparable series per area and commodity.

    A series is preferred by name if the commodity names one, else by its latest year, then by its
    number of records, then by name. Records sharing a year are ordered by source, then value.
    """
    spec = F.broadcast(commodities(records.sparkSession))  # fixed five rows
    numeric = parse_statistics(records).where(F.col("value_numeric").isNotNull()).join(spec, "commodity_desc")
    usable = numeric.where(
        F.col("unit_contains").isNull() | F.upper(F.coalesce("unit_desc", F.lit(""))).contains(F.col("unit_contains"))
    )
    keys = [*area, "commodity_desc"]
    series = usable.groupBy(*keys, "short_desc").agg(
        F.max(F.coalesce(F.col("short_desc") == F.col("preferred"), F.lit(False))).alias("is_preferred"),
        F.max("year").alias("latest"), F.count(F.lit(1)).alias("n"),
    )
    # One row per series: pick by the greatest (preferred, latest, n), the lowest name on ties.
    rank = Window.partitionBy(*keys).orderBy(F.desc("is_preferred"), F.desc("latest"), F.desc("n"), "short_desc")
    chosen = series.withColumn("_r", F.row_number().over(rank)).where("_r = 1").select(*keys, "short_desc")
    rows = usable.join(chosen, [*keys, "short_desc"])
    # Top rows per key are cut on the map side already, so a long series does not travel whole.
    newest = Window.partitionBy(*keys).orderBy(
        F.desc("year"), F.desc("source_desc"), F.desc("value_numeric"), F.desc("unit_desc")
    )
    return rows.withColumn("period_rank", F.row_number().over(newest)).where(F.col("period_rank") <= trailing)


def yields_document(headline: DataFrame, area: list[str]) -> DataFrame:
    """Per area, a map from commodity to label, unit, periods (newest first) and the latest period."""
    period = F.struct(
        "period_rank", "year", F.col("value_numeric").alias("value"), F.col("source_desc").alias("source")
    )
    per = headline.groupBy(*area, "commodity_desc", "label", "statistic").agg(
        F.array_sort(F.collect_list(period)).alias("periods"),
        F.min_by("unit_desc", "period_rank").alias("unit"), F.first("short_desc").alias("series"),
    )
    body = F.struct(
        "label", "statistic", "unit", "series",
        F.transform("periods", lambda p: p.dropFields("period_rank")).alias("periods"),
        F.col("periods")[0].dropFields("period_rank").alias("latest"),
    )
    return per.groupBy(*area).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("commodity_desc", body.alias("body"))))).alias("yields")
    )


def coverage_group(state: Column) -> Column:
    return first_match(
        [(state.isin(FULL_COVERAGE_STATES), "full"), (state.isin(LIMITED_COVERAGE_STATES), "limited")], "none"
    )


def coverage_by_state(parcels: DataFrame) -> DataFrame:
    located = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    out = parcels.where(F.col("state_code").isNotNull()).groupBy("state_code").agg(
        F.count(F.lit(1)).alias("parcel_count"),
        F.count_if(located).alias("with_coordinates"),
        F.avg("acres").alias("avg_acres"), F.min("acres").alias("min_acres"), F.max("acres").alias("max_acres"),
        F.min("latitude").alias("min_lat"), F.max("latitude").alias("max_lat"),
        F.min("longitude").alias("min_lon"), F.max("longitude").alias("max_lon"),
    )
    return out.withColumn("coverage", coverage_group(F.col("state_code")))


def coverage_totals(by_state: DataFrame) -> DataFrame:
    full = F.col("coverage") == "full"
    return by_state.agg(
        F.sum("parcel_count").alias("total_parcels"),
        F.sum("with_coordinates").alias("parcels_with_coords"),
        F.sum(F.when(full, F.col("with_coordinates")).otherwise(0)).alias("eligible_parcels"),
        F.sum(F.when(~full, F.col("with_coordinates")).otherwise(0)).alias("alternative_parcels"),
    )


def likelihood(by_state: DataFrame) -> DataFrame:
    """Score 0–100 for finding crop rasters in a state, with the advice band."""
    state = F.col("state_code")
    parts = (
        F.when(F.col("coverage") == "full", 40).when(F.col("coverage") == "limited", 10).otherwise(0)
        + F.when(state.isin(MAJOR_FARM_STATES), 30).when(state.isin(MIXED_FARM_STATES), 20).otherwise(0)
        + F.when(F.col("avg_acres") > 100, 20).when(F.col("avg_acres") > 10, 10).otherwise(0)
        + F.when(
            F.coalesce(F.col("max_lat").between(25, 49) & F.col("min_lon").between(-125, -66), F.lit(False)), 10
        ).otherwise(0)
    )
    band = first_match([(parts >= 70, "high"), (parts >= 40, "moderate")], "low")
    return by_state.withColumns({"overall_score": parts, "advice": band})


def source_strategy(totals: DataFrame) -> DataFrame:
    """Which source leads, by the share of located parcels with crop rasters; null without parcels."""
    share = F.when(F.col("parcels_with_coords") > 0, F.col("eligible_parcels") / F.col("parcels_with_coords"))
    name = first_match(
        [
            (share.isNull(), None), (share > 0.8, "CDL_FOCUSED"), (share > 0.4, "HYBRID_APPROACH"),
        ],
        "ALTERNATIVE_FOCUSED",
    )
    return totals.withColumns({"eligible_share": share, "primary_strategy": name})
