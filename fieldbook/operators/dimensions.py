"""Fixed dimension tables. All are short literals, so broadcasting them is bounded by this file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Land-cover classes (code, name, category, colour, agricultural, natural).
LAND_COVER_CLASSES = [
    (11, "Open Water", "Water", "#476BA0", False, True),
    (12, "Perennial Ice/Snow", "Ice/Snow", "#D1DDF9", False, True),
    (21, "Developed, Open Space", "Developed", "#DECACA", False, False),
    (22, "Developed, Low Intensity", "Developed", "#D99482", False, False),
    (23, "Developed, Medium Intensity", "Developed", "#EB0000", False, False),
    (24, "Developed, High Intensity", "Developed", "#AB0000", False, False),
    (31, "Barren Land (Rock/Sand/Clay)", "Barren", "#B3AC9F", False, True),
    (41, "Deciduous Forest", "Forest", "#68AB5F", False, True),
    (42, "Evergreen Forest", "Forest", "#1C5F2C", False, True),
    (43, "Mixed Forest", "Forest", "#B5C58F", False, True),
    (51, "Dwarf Scrub", "Shrubland", "#AF963C", False, True),
    (52, "Shrub/Scrub", "Shrubland", "#CCB879", False, True),
    (71, "Grassland/Herbaceous", "Herbaceous", "#DFDFC2", False, True),
    (72, "Sedge/Herbaceous", "Herbaceous", "#D1D182", False, True),
    (73, "Lichens", "Herbaceous", "#A3CC51", False, True),
    (74, "Moss", "Herbaceous", "#82BA9E", False, True),
    (81, "Pasture/Hay", "Planted/Cultivated", "#DCD939", True, False),
    (82, "Cultivated Crops", "Planted/Cultivated", "#AB6C28", True, False),
    (90, "Woody Wetlands", "Wetlands", "#B8D9EB", False, True),
    (95, "Emergent Herbaceous Wetlands", "Wetlands", "#6C9FB8", False, True),
]

# Crop raster codes.
CROP_NAMES = {
    1: "Corn", 2: "Cotton", 3: "Rice", 4: "Sorghum", 5: "Soybeans", 6: "Sunflower", 10: "Peanuts", 11: "Tobacco",
    12: "Sweet Corn", 13: "Pop or Orn Corn", 14: "Mint", 21: "Barley", 22: "Durum Wheat", 23: "Spring Wheat",
    24: "Winter Wheat", 25: "Other Small Grains", 26: "Dbl Crop WinWht/Soybeans", 27: "Rye", 28: "Oats",
    29: "Millet", 30: "Speltz", 31: "Canola", 32: "Flaxseed", 33: "Safflower", 34: "Rape Seed", 35: "Mustard",
    36: "Alfalfa", 37: "Other Hay/Non Alfalfa", 38: "Camelina", 39: "Buckwheat", 41: "Sugarbeets",
    42: "Dry Beans", 43: "Potatoes", 44: "Other Crops", 45: "Sugarcane", 46: "Sweet Potatoes",
    47: "Misc Vegs & Fruits", 48: "Watermelons", 49: "Onions", 50: "Cucumbers", 51: "Chick Peas", 52: "Lentils",
    53: "Peas", 54: "Tomatoes", 55: "Caneberries", 56: "Hops", 57: "Herbs", 58: "Clover/Wildflowers",
    59: "Sod/Grass Seed", 60: "Switchgrass", 61: "Fallow/Idle Cropland", 63: "Forest", 64: "Shrubland",
    65: "Barren", 81: "Clouds/No Data", 82: "Developed", 83: "Water", 87: "Wetlands", 88: "Nonag/Undefined",
    92: "Aquaculture", 111: "Open Water", 112: "Perennial Ice/Snow", 121: "Developed/Open Space",
    122: "Developed/Low Intensity", 123: "Developed/Med Intensity", 124: "Developed/High Intensity",
    131: "Barren", 141: "Deciduous Forest", 142: "Evergreen Forest", 143: "Mixed Forest", 152: "Shrubland",
    176: "Grassland/Pasture", 190: "Woody Wetlands", 195: "Herbaceous Wetlands",
}

# Crop category of a code; codes not listed are Other.
CROP_CATEGORIES = {
    "Corn": [1, 12, 13],
    "Soybeans": [5, 26],
    "Wheat": [21, 22, 23, 24, 25],
    "Cotton": [2],
    "Rice": [3],
    "Sorghum": [4],
    "Hay": [36, 37],
    "Specialty Crops": [41, 42, 43, 44, 45, 46, 47, 48, 49, 50, 51, 52, 53, 54],
    "Fallow": [61],
    "Pasture": [176],
    "Forest": [63, 141, 142, 143],
    "Developed": [82, 121, 122, 123, 124],
    "Water": [83, 111],
    "Wetlands": [87, 190, 195],
}

# Crop raster coverage by state, and states by agricultural weight.
FULL_COVERAGE_STATES = [
    "AL", "AR", "AZ", "CA", "CO", "CT", "DE", "FL", "GA", "IA", "ID", "IL", "IN", "KS", "KY", "LA", "MA", "MD", "ME", "MI",
    "MN", "MO", "MS", "MT", "NC", "ND", "NE", "NH", "NJ", "NM", "NV", "NY", "OH", "OK", "OR", "PA", "RI", "SC", "SD", "TN",
    "TX", "UT", "VA", "VT", "WA", "WI", "WV", "WY",
]
LIMITED_COVERAGE_STATES = ["AK", "HI"]
MAJOR_FARM_STATES = ["IA", "IL", "IN", "NE", "KS", "MN", "MO", "OH", "WI"]
MIXED_FARM_STATES = ["TX", "CA", "FL", "GA", "NC", "AR", "MS", "AL"]
CROP_HISTORY_STATES = [
    "TX", "IA", "IL", "IN", "KS", "NE", "MN", "MO", "OH", "WI", "OK", "AR", "MS", "AL", "GA", "FL", "SC", "NC", "VA", "MD",
    "DE", "NJ", "PA", "NY", "CT", "RI", "MA", "VT", "NH", "ME",
]

# Headline commodities (label, unit filter, preferred series).
COMMODITIES = [
    ("CORN", "YIELD", "corn", "ACRE", None),
    ("SOYBEANS", "YIELD", "soybeans", "ACRE", None),
    ("WHEAT", "YIELD", "wheat", "ACRE", None),
    ("HAY", "YIELD", "hay", "ACRE", None),
    ("CATTLE", "INVENTORY", "cattle", "HEAD", "CATTLE, INCL CALVES - INVENTORY"),
]

# State bounding boxes for the station search (min lat, max lat, min lon, max lon).
STATION_BOXES = [
    ("TX", 25.8, 36.5, -106.6, -93.5),
    ("OK", 33.6, 37.0, -103.0, -94.4),
    ("NM", 31.3, 37.0, -109.1, -103.0),
]


def land_cover_classes(spark: SparkSession) -> DataFrame:
    schema = (
        "nlcd_code int, class_name string, class_category string, class_color string, "
        "is_agricultural boolean, is_natural boolean"
    )
    return spark.createDataFrame(LAND_COVER_CLASSES, schema)


def crop_classes(spark: SparkSession) -> DataFrame:
    category = {code: name for name, codes in CROP_CATEGORIES.items() for code in codes}
    rows = [(code, name, category.get(code, "Other")) for code, name in CROP_NAMES.items()]
    return spark.createDataFrame(rows, "crop_code int, crop_name string, crop_category string")


def commodities(spark: SparkSession) -> DataFrame:
    schema = "commodity_desc string, statistic string, label string, unit_contains string, preferred string"
    return spark.createDataFrame(COMMODITIES, schema)


def name_crops(df: DataFrame, code: str = "crop_code") -> DataFrame:
    """Attach crop name and category; codes outside the list read ``Unknown (n)`` / Other."""
    dim = crop_classes(df.sparkSession).withColumnRenamed("crop_code", "_code")
    out = df.join(F.broadcast(dim), df[code] == dim["_code"], "left").drop("_code")
    unknown = F.concat(F.lit("Unknown ("), F.col(code).cast("string"), F.lit(")"))
    return out.withColumn("crop_name", F.coalesce("crop_name", F.when(F.col(code).isNotNull(), unknown))).withColumn(
        "crop_category", F.coalesce("crop_category", F.when(F.col(code).isNotNull(), F.lit("Other")))
    )
