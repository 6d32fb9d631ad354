"""Raw documents to typed, cleaned, flagged parcel rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.functions.values import first_match, guarded_ratio, surrogate_key

RAW_COLUMNS = [
    "file_name", "file_row_number", "ingestion_timestamp", "ingestion_type", "county", "chunk_index", "parcel_count",
]

# The names under which sources deliver each field, in order of preference.
TEXT_FIELDS = {
    "parcel_id": ["id"], "regrid_id": ["regrid_id"], "fips_code": ["fips_code"], "state": ["state"],
    "parcel_county": ["county"], "address": ["address"], "city": ["city"], "zip_code": ["zip_code"],
    "owner_name": ["owner_name"], "owner_address": ["owner_address"], "property_type": ["property_type"],
    "land_use_code": ["land_use_code"], "land_use_description": ["land_use_description"], "zoning": ["zoning"],
}
NUMBER_FIELDS = {
    "acres": (["acres"], "double"),
    "square_feet": (["square_feet"], "bigint"),
    "assessed_value": (["assessed_value", "assessed_total_value", "parval", "fields.parval"], "decimal(12,2)"),
    "market_value": (
        ["market_value", "mktval", "fields.mktval", "saleprice", "fields.saleprice"], "decimal(12,2)"
    ),
    "tax_amount": (["tax_amount", "taxamt", "fields.taxamt"], "decimal(10,2)"),
    "tax_year": (["tax_year", "taxyear", "fields.taxyear"], "int"),
    "year_built": (["year_built"], "int"),
    "building_count": (["building_count"], "bigint"),
    "improvement_value": (["improvement_value", "improvval", "fields.improvval"], "decimal(12,2)"),
    "land_value": (["land_value", "landval", "fields.landval"], "decimal(12,2)"),
}
FARM_WORDS = "farm|agriculture|crop|pasture|ranch"


def recent(raw: DataFrame, as_of: dt.datetime | Column, days: int, ts: str = "ingestion_timestamp") -> DataFrame:
    """Rows not older than ``days`` calendar days before ``as_of``; a plain range filter that reaches the scan."""
    if isinstance(as_of, Column):
        return raw.where(F.col(ts) >= F.date_sub(F.to_date(as_of), days))
    start = dt.datetime.combine(as_of.date() - dt.timedelta(days=days), dt.time())
    return raw.where(F.col(ts) >= F.lit(start))


def _plain_names(fields: Sequence[str] | None) -> list[str]:
    """Top-level aliases of the fields that are read, without the nested ones."""
    paths = TEXT_FIELDS | {n: p for n, (p, _) in NUMBER_FIELDS.items()} | {"geometry_json": ["geometry"]}
    return sorted({p for n, aliases in paths.items() if fields is None or n in fields for p in aliases if "." not in p})


def _parcel_type(names: Sequence[str]) -> str:
    """Every alias as text, so that odd values are kept for the lenient cast that follows. The nested ones are always read, since
    a document of another shape there is not well-formed; text can be read from any value, so leaving out a name changes no row."""
    nested = sorted({p[7:] for paths, _ in NUMBER_FIELDS.values() for p in paths if p.startswith("fields.")})
    return ", ".join([*[f"{n}: string" for n in names], f"fields: struct<{', '.join(f'{n}: string' for n in nested)}>"])


def flatten_parcels(raw: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """One row per parcel, with its position in the document; documents without parcels give none.

    The list of parcels may be the document itself or sit under ``parcels``, ``features`` or
    ``results``; any other well-formed object is one parcel. The text is parsed once, straight into
    the fields that later steps use: all, or those named by ``fields``.
    """
    names = _plain_names(fields)
    parcel = _parcel_type(names)
    text = F.col("raw_data")
    is_list = F.ltrim(text).startswith("[")
    shapes = ", ".join(f"{n}: array<struct<{parcel}>>" for n in ("parcels", "features", "results"))
    docs = raw.withColumns(
        {
            "_list": F.when(is_list, F.from_json(text, f"array<struct<{parcel}>>")),
            "_doc": F.when(~is_list, F.from_json(text, f"struct<{parcel}, {shapes}, _corrupt_record: string>")),
        }
    )
    alone = F.array(F.struct(*[F.col(f"_doc.{n}").alias(n) for n in [*names, "fields"]]))
    lone = F.when(F.col("_doc").isNotNull() & F.col("_doc._corrupt_record").isNull(), alone)
    found = F.coalesce("_list", "_doc.parcels", "_doc.features", "_doc.results", lone)
    return docs.select(*RAW_COLUMNS, F.posexplode(found).alias("parcel_index_in_chunk", "parcel"))


def _first(paths: list[str], kind: str | None = None) -> Column:
    """First alias that holds a usable value; each is cast before the coalesce."""
    cols = [F.col(f"parcel.{p}") for p in paths]
    return F.coalesce(*[c.try_cast(kind) if kind else c for c in cols])


def extract_fields(flat: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """Typed columns from the parcel, all or those named; every field takes the first alias that holds a value.

    Money is read as double and then rounded to the column's scale, so that a value with more
    decimals than the column is kept instead of failing the cast.
    """
    wanted = {*TEXT_FIELDS, *NUMBER_FIELDS, "geometry_json"} if fields is None else set(fields)
    cols = [_first(paths).alias(n) for n, paths in TEXT_FIELDS.items() if n in wanted]
    for name, (paths, kind) in NUMBER_FIELDS.items():
        if name not in wanted:
            continue
        value = _first(paths, "double")
        cols.append((value if kind == "double" else value.try_cast(kind)).alias(name))
    keep = [c for c in flat.columns if c != "parcel"]
    if "geometry_json" in wanted:
        cols.append(F.col("parcel.geometry").alias("geometry_json"))
    return flat.select(*keep, *cols)


def quality_flag() -> Column:
    return first_match(
        [
            (F.col("parcel_id").isNull(), "missing_id"),
            (F.col("acres").isNull() | (F.col("acres") <= 0), "invalid_acres"),
            (F.col("geometry_json").isNull(), "missing_geometry"),
        ],
        "valid",
    )


def size_category(acres: Column) -> Column:
    return first_match(
        [(acres.isNull(), "unknown"), (acres < 1, "small"), (acres <= 10, "medium"), (acres <= 100, "large")],
        "very_large",
    )


def is_farm_use(description: Column) -> Column:
    return F.coalesce(F.lower(description).rlike(FARM_WORDS), F.lit(False))


def clean_columns(parsed: DataFrame) -> DataFrame:
    trimmed = {
        c: F.trim(c)
        for c in (
            "address", "city", "zip_code", "owner_name", "owner_address", "property_type", "land_use_code",
            "land_use_description", "zoning",
        )
    }
    return parsed.withColumns(
        trimmed
        | {
            "state": F.upper(F.trim("state")),
            "county_name": F.upper(F.trim(F.coalesce("parcel_county", "county"))),
        }
    ).drop("parcel_county")


def add_ratios(df: DataFrame) -> DataFrame:
    acres, assessed, market = F.col("acres"), F.col("assessed_value").cast("double"), F.col("market_value").cast("double")
    return df.withColumns(
        {
            "assessed_value_per_acre": guarded_ratio(assessed, acres),
            "assessment_ratio": F.when((market > 0) & (assessed > 0), assessed / market),
        }
    )


def stage_parcels(
    raw: DataFrame, as_of: dt.datetime | None = None, retention_days: int | None = 90, numbers: Sequence[str] | None = None
) -> DataFrame:
    """The staging table: flatten, extract, flag, clean, categorise; rows without an id are dropped. Where ``numbers`` names number
    fields, only those and the ones that this step uses itself are read."""
    fields = None if numbers is None else [*TEXT_FIELDS, "acres", "assessed_value", "market_value", "geometry_json", *numbers]
    if retention_days is not None:
        raw = recent(raw, as_of if as_of is not None else F.current_timestamp(), retention_days)
    stamp = F.lit(as_of) if as_of is not None else F.current_timestamp()
    parsed = extract_fields(flatten_parcels(raw, fields), fields).withColumns(
        {
            "data_quality_flag": quality_flag(),
            "record_id": surrogate_key("file_name", "file_row_number", "parcel_index_in_chunk"),
        }
    )
    kept = clean_columns(parsed.where(F.col("data_quality_flag") != "missing_id"))
    return add_ratios(kept).withColumns(
        {
            "size_category": size_category(F.col("acres")),
            "is_agricultural": is_farm_use(F.col("land_use_description")),
            "processed_at": stamp,
        }
    )
