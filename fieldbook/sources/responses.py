"""Landed responses of remote services, to typed rows. Fetching them is not part of this library."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.functions.documents import pick
from fieldbook.functions.values import METRES_TO_FEET, iso_day, statistic_value
from fieldbook.operators.dimensions import CROP_NAMES, name_crops

# Property names that carry a class code, in order of preference.
POLYGON_CODE_FIELDS = ["NLCD_Land_Cover_Class", "landcover", "class", "value"]
POINT_CODE_FIELDS = [*POLYGON_CODE_FIELDS, "pixel_value", "PALETTE_INDEX"]
NO_ELEVATION = -1000000.0


def land_cover_features(responses: DataFrame, text: str, point: bool = False) -> DataFrame:
    """One row per feature of a response: class code and area (1.0 when the feature has none)."""
    features = F.try_variant_get(F.try_parse_json(text), "$.features", "array<variant>")
    rows = responses.withColumn("_f", F.explode(features))
    names = POINT_CODE_FIELDS if point else POLYGON_CODE_FIELDS
    code = pick(F.col("_f"), [f"properties.{n}" for n in names], "int")
    area = F.coalesce(pick(F.col("_f"), ["properties.area", "properties.Shape_Area"], "double"), F.lit(1.0))
    return rows.withColumns({"nlcd_code": code, "area": area}).drop("_f", text).where(F.col("nlcd_code").isNotNull())


def elevation(text: Column) -> Column:
    """Elevation in feet from either response shape; the no-data value is null."""
    doc = F.try_parse_json(text)
    value = F.nullif(pick(doc, ["value", "Elevation_Query[0].Elevation"], "double"), F.lit(NO_ELEVATION))
    units = F.lower(F.coalesce(pick(doc, ["units", "Elevation_Query[0].Units"], "string"), F.lit("feet")))
    return F.when(units.isin("meters", "metres", "m"), value * METRES_TO_FEET).otherwise(value)


def crop_code(xml: Column) -> Column:
    """Code from a raster answer: the result element, else any element with a known code."""
    known = F.array(*[F.lit(c) for c in CROP_NAMES])
    named = F.regexp_extract(xml, r"<Result>\s*(\d+)\s*</Result>", 1).try_cast("int")
    numbers = F.transform(F.regexp_extract_all(xml, F.lit(r">\s*(\d+)\s*<"), 1), lambda t: t.try_cast("int"))
    return F.coalesce(named, F.get(F.filter(numbers, lambda n: F.array_contains(known, n)), F.lit(0)))


def crop_answers(responses: DataFrame, text: str) -> DataFrame:
    """Code, name, category and success flag of every answer."""
    coded = name_crops(responses.withColumn("crop_code", crop_code(F.col(text))).drop(text))
    return coded.withColumn("query_success", F.col("crop_code").isNotNull())


STATISTIC_TYPE = (
    "data array<struct<year: string, Value: string, unit_desc: string, reference_period_desc: string, short_desc: string, "
    "source_desc: string, commodity_desc: string>>"
)


def statistics(responses: DataFrame, text: str) -> DataFrame:
    """Rows of a statistics answer: year, upper-case keys, numeric value or null when suppressed."""
    rows = responses.withColumn("_r", F.explode(F.from_json(text, STATISTIC_TYPE)["data"]))
    r = F.col("_r")
    return rows.withColumns(
        {
            "year": r["year"].try_cast("int"), "value_text": r["Value"], "value_numeric": statistic_value(r["Value"]),
            "commodity_desc": F.upper(r["commodity_desc"]), "short_desc": F.upper(r["short_desc"]), "unit_desc": r["unit_desc"],
            "source_desc": F.upper(r["source_desc"]), "reference_period": r["reference_period_desc"],
        }
    ).drop("_r", text)


RIGHT_TYPE = (
    "ResultList array<struct<structureName: string, structureType: string, waterSource: string, appropriationDate: string, "
    "adjudicationDate: string, adminNumber: string, priorityNumber: string, netAbsolute: double, netConditional: double, "
    "decreedUnits: string, decreedUses: string, latitude: double, longitude: double, wdid: string, division: string, "
    "waterDistrict: string, county: string>>"
)
RIGHT_COLUMNS = {
    "structureName": "structure_name", "structureType": "structure_type", "waterSource": "water_source",
    "appropriationDate": "appropriation_date", "adjudicationDate": "adjudication_date", "adminNumber": "admin_number",
    "priorityNumber": "priority_number", "netAbsolute": "net_absolute", "netConditional": "net_conditional",
    "decreedUnits": "decreed_units", "decreedUses": "decreed_uses", "latitude": "latitude", "longitude": "longitude",
    "wdid": "wdid", "division": "division", "waterDistrict": "water_district", "county": "county",
}


def water_rights(responses: DataFrame, text: str) -> DataFrame:
    """Typed rows of a rights answer; dates keep only their day."""
    rows = responses.withColumn("_r", F.explode(F.from_json(text, RIGHT_TYPE)["ResultList"]))
    cols = []
    for name, out in RIGHT_COLUMNS.items():
        value = F.col("_r")[name]
        cols.append((iso_day(value) if name.endswith("Date") else value).alias(out))
    keep = [c for c in responses.columns if c != text]
    return rows.select(*keep, *cols)
