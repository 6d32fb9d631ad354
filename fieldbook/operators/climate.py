"""Weather stations: quality filter and coverage reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.operators.dimensions import STATION_BOXES


def usable_stations(stations: DataFrame, min_year: int = 2023, min_coverage: float = 0.7) -> DataFrame:
    """Recent, well covered stations, once for every searched state whose box they lie in."""
    good = stations.where((F.col("max_year") >= min_year) & (F.col("data_coverage") > min_coverage))
    lat, lon = F.col("latitude"), F.col("longitude")
    found = F.array_compact(
        F.array(
            *[
                F.when(lat.between(south, north) & lon.between(west, east), name)
                for name, south, north, west, east in STATION_BOXES
            ]
        )
    )
    return good.withColumn("search_state", F.explode(found))


def latest_climate(climate: DataFrame) -> DataFrame:
    """The newest year of each station."""
    rest = [c for c in climate.columns if c != "station_id"]
    best = climate.groupBy("station_id").agg(F.max_by(F.struct(*rest), F.col("data_year")).alias("b"))
    return best.select("station_id", "b.*")


def assignment_coverage(parcels: DataFrame, assigned: DataFrame, by_state: bool = False) -> DataFrame:
    """Located parcels, how many have a station, how many have climate values, and the rates."""
    located = parcels.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    a = assigned.select("parcel_id", "station_id", F.col("precipitation").isNotNull().alias("has_climate"))
    joined = located.select("parcel_id", "state_code").join(a, "parcel_id", "left")
    aggs = [
        F.count(F.lit(1)).alias("total_parcels"),
        F.count("station_id").alias("with_assignments"),
        F.count_if(F.coalesce("has_climate", F.lit(False))).alias("with_climate_data"),
        F.countDistinct("station_id").alias("unique_stations"),
    ]
    out = (joined.groupBy("state_code") if by_state else joined).agg(*aggs)
    total = F.col("total_parcels")
    return out.withColumns(
        {
            "assignment_rate": F.when(total > 0, F.col("with_assignments") / total).otherwise(0.0),
            "coverage_rate": F.when(total > 0, F.col("with_climate_data") / total).otherwise(0.0),
        }
    )


def station_coverage(stations: DataFrame, climate: DataFrame) -> DataFrame:
    have = climate.select("station_id").distinct().withColumn("has", F.lit(True))
    out = stations.join(have, "station_id", "left").agg(
        F.count(F.lit(1)).alias("total_stations"), F.count("has").alias("with_climate_data")
    )
    total = F.col("total_stations")
    return out.withColumn("collection_rate", F.when(total > 0, F.col("with_climate_data") / total).otherwise(0.0))
