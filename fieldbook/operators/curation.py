"""Staged parcels to the curated parcel profile."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.functions.geo import geometry_to_wkt
from fieldbook.functions.values import first_match, surrogate_key, text_or, within
from fieldbook.operators.ranking import latest_by

CURATED_COLUMNS = [
    "regrid_id", "fips_code", "state", "county_name", "address", "city", "zip_code", "owner_name", "owner_address",
    "acres", "square_feet", "property_type", "land_use_code", "land_use_description", "zoning", "assessed_value",
    "market_value", "tax_amount", "tax_year", "geometry_json", "year_built", "building_count", "improvement_value",
    "land_value", "assessed_value_per_acre", "assessment_ratio", "size_category", "is_agricultural",
    "ingestion_timestamp", "processed_at", "record_id",
]

# The carried columns behind each output column that is not carried under its own name.
MADE_FROM = {
    "property_category": ["property_type", "is_agricultural"], "value_category": ["assessed_value"], "age_category": ["year_built"],
    "investment_potential": ["property_type", "is_agricultural", "assessed_value", "acres", "assessed_value_per_acre"],
    "parcel_wkt": ["geometry_json"], "source_ingestion_timestamp": ["ingestion_timestamp"],
    "source_processed_timestamp": ["processed_at"], "created_at": [], "updated_at": [],
    "parcel_hash": ["regrid_id", "address", "owner_name", "acres", "assessed_value", "market_value", "property_type"],
}


def latest_parcels(staged: DataFrame, columns: Sequence[str] = CURATED_COLUMNS) -> DataFrame:
    """The newest valid record of each parcel; record_id settles equal times. Only ``columns`` are sorted and shuffled beside the
    order: the planner does not prune the record that the aggregate keeps."""
    newest = ["ingestion_timestamp", "processed_at", "record_id"]
    valid = staged.where(F.col("data_quality_flag") == "valid")
    return latest_by(valid.select("parcel_id", *columns, F.struct(*newest).alias("_newest")), ["parcel_id"], ["_newest"], columns)


def valid_zip(c: Column) -> Column:
    return F.when(c.rlike("^[0-9]{5}$"), c)


def range_guards(year: Column | int) -> dict[str, Column]:
    """Values outside their plausible range become NULL."""
    big = 1_000_000_000

    def g(name, *args, **kw):
        return within(F.col(name), *args, **kw)

    return {
        "acres": g("acres", 0, 100000, low_open=True, high_open=True),
        "square_feet": g("square_feet", 0, big, low_open=True, high_open=True),
        "assessed_value": g("assessed_value", 0, big, low_open=True, high_open=True),
        "market_value": g("market_value", 0, big, low_open=True, high_open=True),
        "tax_amount": g("tax_amount", 0, 10_000_000, high_open=True),
        "tax_year": g("tax_year", 1900, year),
        "year_built": g("year_built", 1800, year),
        "building_count": g("building_count", 0, 1000, high_open=True),
        "improvement_value": g("improvement_value", 0, big, high_open=True),
        "land_value": g("land_value", 0, big, high_open=True),
    }


def value_category(assessed: Column) -> Column:
    return first_match(
        [
            (assessed.isNull(), "Unknown"),
            (assessed < 50000, "Low Value"),
            (assessed <= 200000, "Medium Value"),
            (assessed <= 500000, "High Value"),
        ],
        "Premium Value",
    )


def age_category(built: Column, year: Column | int) -> Column:
    age = F.lit(year) - built if isinstance(year, int) else year - built
    return first_match(
        [
            (built.isNull(), "Unknown"),
            (age <= 10, "New (0-10 years)"),
            (age <= 30, "Modern (11-30 years)"),
            (age <= 50, "Mature (31-50 years)"),
        ],
        "Historic (50+ years)",
    )


def property_category(kind: Column, farm: Column) -> Column:
    k = F.coalesce(F.lower(kind), F.lit(""))
    return first_match(
        [
            (k.contains("residential"), "Residential"),
            (k.contains("commercial"), "Commercial"),
            (k.contains("industrial"), "Industrial"),
            (k.contains("agricultural") | farm, "Agricultural"),
            (k.contains("vacant"), "Vacant"),
        ],
        "Other",
    )


def investment_potential(category: Column, assessed: Column, acres: Column, per_acre: Column, farm: Column) -> Column:
    return first_match(
        [
            (assessed.isNull() | acres.isNull(), None),
            (farm & (acres > 10) & (per_acre < 10000), "High"),
            ((category == "Residential") & assessed.between(100000, 300000), "Medium"),
            ((category == "Commercial") & (assessed > 200000), "High"),
        ],
        "Low",
    )


def curate_parcels(staged: DataFrame, as_of: dt.datetime | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """The curated profile: one cleaned, categorised row per parcel, with all its columns or those named.

    Categories are taken from the staged values, the output columns from the guarded ones.
    """
    if columns is not None:
        needed = {c for name in columns for c in MADE_FROM.get(name, [name])}
        carried = [c for c in CURATED_COLUMNS if c in needed]
        # What is not carried is read by no column that is returned.
        kinds = {f.name: f.dataType for f in staged.schema}
        blank = {c: F.lit(None).cast(kinds.get(c, "string")) for c in CURATED_COLUMNS if c not in needed}
        latest = latest_parcels(staged, carried).withColumns(blank)
        return _profile(latest, as_of).select(*columns)
    return _profile(latest_parcels(staged), as_of)


def _profile(latest: DataFrame, as_of: dt.datetime | None) -> DataFrame:
    now = F.lit(as_of) if as_of is not None else F.current_timestamp()
    year = as_of.year if as_of is not None else F.year(F.current_date())
    assessed, acres, farm = F.col("assessed_value"), F.col("acres"), F.col("is_agricultural")
    base = latest.withColumns(
        {
            "property_category": property_category(F.col("property_type"), farm),
            "value_category": value_category(assessed),
            "age_category": age_category(F.col("year_built"), year),
        }
    )
    base = base.withColumn(
        "investment_potential",
        investment_potential(F.col("property_category"), assessed, acres, F.col("assessed_value_per_acre"), farm),
    )
    cleaned = base.withColumns(
        range_guards(year)
        | {
            "address": text_or("address", "Address Not Available"),
            "city": text_or("city", "Unknown"),
            "zip_code": valid_zip(F.col("zip_code")),
            "owner_name": text_or("owner_name", "Owner Not Available"),
            "property_type": text_or("property_type", "Unknown"),
            "land_use_description": text_or("land_use_description", "Unknown"),
            "parcel_wkt": geometry_to_wkt(F.col("geometry_json")),
            "source_ingestion_timestamp": F.col("ingestion_timestamp"),
            "source_processed_timestamp": F.col("processed_at"),
            "created_at": now,
            "updated_at": now,
        }
    )
    hashed = cleaned.withColumn(
        "parcel_hash",
        surrogate_key(
            "parcel_id", "regrid_id", "address", "owner_name", "acres", "assessed_value", "market_value", "property_type"
        ),
    )
    return hashed.drop("ingestion_timestamp", "processed_at", "record_id", "geometry_json")
