"""Lookup requests and processing events: classification, keys, and the batch lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.functions.values import first_match
from fieldbook.operators.spatial import nearest

# Whether parcels of a source are enriched without being asked.
AUTO_ENRICH = {"s3_ingestion": True, "api_ingestion": False, "bulk_ingestion": True}


def classify_request(coordinates: Column, address: Column, parcel_id: Column) -> Column:
    filled = lambda c: F.length(F.trim(c)) > 0
    return first_match(
        [(F.size(coordinates) == 2, "coordinates"), (filled(address), "address"), (filled(parcel_id), "parcel_id")], "unknown"
    )


def repaired_point(coordinates: Column) -> Column:
    """struct(latitude, longitude) from either order; the order is clear when one value exceeds 90."""
    a, b = F.get(coordinates, F.lit(0)), F.get(coordinates, F.lit(1))
    swapped = b.between(-90, 90) & (F.abs(a) > 90)
    return F.struct(F.when(swapped, b).otherwise(a).alias("latitude"), F.when(swapped, a).otherwise(b).alias("longitude"))


def plain_address(c: Column) -> Column:
    return F.regexp_replace(F.upper(F.trim(c)), r"[^A-Z0-9]+", " ")


def lookup(requests: DataFrame, profile: DataFrame, key: str) -> DataFrame:
    """The parcel each request asks for, by id, by normalised address, or the nearest one to its coordinates; unmatched requests stay.

    ``key`` identifies a request. Each kind of request meets the profile on its own, so that no join holds the others under one
    null key.
    """
    by_id = profile.select(F.col("parcel_id").alias("_id"), F.col("parcel_id").alias("found"))
    by_address = profile.groupBy(plain_address(F.col("address")).alias("_address")).agg(F.min("parcel_id").alias("found"))
    kind = F.col("query_type")
    named = requests.where(kind == "parcel_id").join(by_id, F.trim("parcel_id") == F.col("_id"), "left").drop("_id")
    at_address = requests.where(kind == "address").join(by_address, plain_address(F.col("address")) == F.col("_address"), "left").drop("_address")
    placed = requests.where(kind == "coordinates")
    asked = placed.select(key, repaired_point(F.col("coordinates")).alias("_p")).select(key, "_p.*")
    places = profile.select(F.col("parcel_id").alias("found"), "latitude", "longitude")
    near = nearest(asked, places, key, "found").select(key, "found")
    others = requests.where(~kind.isin("parcel_id", "address", "coordinates")).withColumn("found", F.lit(None).cast("string"))
    return named.unionByName(at_address).unionByName(placed.join(near, key, "left")).unionByName(others)


def parcel_of_cache_key(key: Column) -> Column:
    """Parcel id encoded in a cache key."""
    rest = F.regexp_replace(key, "^parcel:[a-z]+:", "")
    return (
        F.when(key.startswith("parcel:coords:"), F.concat(F.lit("coords_"), F.regexp_replace(rest, ":", "_")))
        .when(key.startswith("parcel:address:"), F.concat(F.lit("address_"), rest))
        .when(key.startswith("parcel:id:"), rest)
        .otherwise(F.regexp_replace(key, ":", "_"))
    )


def unwrap(event: Column) -> Column:
    """array<variant> of the inner events: queue bodies and topic messages, else the event itself."""
    doc = F.try_parse_json(event)
    records = F.try_variant_get(doc, "$.Records", "array<variant>")
    inner = F.transform(
        records,
        lambda r: F.coalesce(
            F.try_parse_json(F.try_variant_get(r, "$.body", "string")), F.try_parse_json(F.try_variant_get(r, "$.Sns.Message", "string")), r
        ),
    )
    return F.coalesce(inner, F.when(doc.isNotNull(), F.array(doc)))


def classify_event(event: Column) -> Column:
    text = lambda p: F.try_variant_get(event, f"$.{p}", "string")
    action = text("action")
    return first_match(
        [
            (text("parcel_id").isNotNull(), "single_parcel"),
            (F.try_variant_get(event, "$.parcel_ids", "array<string>").isNotNull(), "batch_parcels"),
            (text("state_code").isNotNull() | (action == "state_bulk_nlcd"), "state_bulk"),
            ((action == "nlcd_enrichment") | text("enrich_nlcd").isNotNull(), "enrichment_trigger"),
        ],
        "single_parcel",
    )


def event_parcels(event: Column) -> Column:
    """Parcel ids named by an event."""
    return F.coalesce(
        F.try_variant_get(event, "$.parcel_ids", "array<string>"), F.array_compact(F.array(F.try_variant_get(event, "$.parcel_id", "string")))
    )


def should_enrich(explicit: Column, source: Column) -> Column:
    """Yes for an explicit wish or for sources that enrich unasked; an explicit no does not hold those back. No for unknown sources."""
    default = F.lit(False)
    for name, value in AUTO_ENRICH.items():
        default = F.when(source == name, value).otherwise(default)
    return F.coalesce(explicit, F.lit(False)) | default
