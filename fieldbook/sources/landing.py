"""Landing zone: raw documents with file metadata, file discovery, path-derived columns, CSV loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldbook.functions.documents import is_salvaged, parcels_of, parse_or_salvage
from fieldbook.session import cut_lineage, if_small

# State names by the token found in a path, a county field or an address.
STATE_TOKENS = {"tx": "texas", "ca": "california", "fl": "florida"}


def county_files(spark: SparkSession, prefixes: Sequence[str], pattern: str = "*.json") -> DataFrame:
    """One row per JSON file below any of the prefixes; overlapping prefixes give a file once."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    return files.load(list(prefixes)).select("path", "modificationTime", "length").distinct()


def scan_documents(spark: SparkSession, paths: str | Sequence[str], whole_file: bool = False, pattern: str = "*.json") -> DataFrame:
    """Raw documents: file name, position in the file, text, and the lifted load fields.

    By default every line is a document and large files are split between tasks. ``whole_file`` reads
    each file as one document, for pretty-printed JSON. The position counts the lines of a file that are
    not blank. A line's number in its split comes from the split it is read in, and the splits of a file
    are added up from their counts, so no text leaves the task that reads it.
    """
    reader = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    lines = reader.text(paths, wholetext=whole_file).select(
        F.col("_metadata.file_path").alias("file_name"), F.col("_metadata.file_block_start").alias("_block"), F.col("value").alias("raw_data")
    )
    lines = lines.where(F.length(F.trim("raw_data")) > 0).withColumn("_line", F.monotonically_increasing_id())
    return lift_fields(_numbered(lines))


def _numbered(lines: DataFrame) -> DataFrame:
    """Adds ``file_row_number``. Both readings deal the files to the same splits, as they share one listing of them."""
    splits = lines.groupBy("file_name", "_block").agg(F.min("_line").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("file_name").orderBy("_block")) - F.col("_n")
    splits = if_small(cut_lineage(splits.select("file_name", "_block", "_first", before.alias("_before"))))
    numbered = lines.join(splits, ["file_name", "_block"])
    return numbered.withColumn("file_row_number", F.col("_line") - F.col("_first") + F.col("_before") + 1).drop("_block", "_line", "_first", "_before")


def lift_fields(raw: DataFrame) -> DataFrame:
    """Load fields of each document next to its text; counts fall back to the parcels found."""
    doc = F.col("_doc")
    out = raw.withColumn("_doc", parse_or_salvage(F.col("raw_data")))
    number = lambda name: F.try_variant_get(doc, f"$.{name}", "bigint")
    text = lambda name: F.try_variant_get(doc, f"$.{name}", "string")
    found = F.size(parcels_of(doc)).cast("bigint")
    return out.withColumns(
        {
            "ingestion_type": F.coalesce(text("ingestion_type"), F.lit("bulk")),
            "county": F.coalesce(text("county"), F.lit("unknown")),
            "chunk_index": number("chunk_index"),
            "parcel_count": F.coalesce(number("parcel_count"), found, F.lit(0)),
            "is_malformed": is_salvaged(doc),
        }
    ).drop("_doc")


def path_columns(path: Column) -> dict[str, Column]:
    """County (fourth segment), file name (last segment) and state named in a path."""
    parts = F.split(F.regexp_replace(path, r"^[a-z0-9]+://[^/]*/", ""), "/")
    state = None
    tokens = F.split(F.lower(path), "[^a-z]+")
    for token, name in STATE_TOKENS.items():
        hit = F.array_contains(tokens, token) | F.array_contains(tokens, name)
        state = F.when(hit, name) if state is None else state.when(hit, name)
    return {
        "path_county": F.get(parts, F.lit(3)),
        "path_file": F.element_at(parts, -1),
        "path_state": state.otherwise("unknown"),
    }


def county_of(county_fields: Sequence[Column], address: Column) -> Column:
    """First filled candidate, else the word before "county" in the address, else unknown."""
    named = [F.lower(F.nullif(F.trim(c), F.lit(""))) for c in county_fields]
    from_address = F.nullif(F.regexp_extract(F.lower(address), r"(\S+) county\b", 1), F.lit(""))
    return F.coalesce(*named, from_address, F.lit("unknown"))


def state_of(state_fields: Sequence[Column], address: Column) -> Column:
    """First filled candidate with codes spelled out, else a state token in the address, else unknown."""
    first = F.coalesce(*[F.lower(F.nullif(F.trim(c), F.lit(""))) for c in state_fields])
    spelled, words, found = first, F.split(F.lower(address), "[^a-z]+"), None
    for token, name in STATE_TOKENS.items():
        spelled = F.when(first == token, name).otherwise(spelled)
        hit = F.array_contains(words, token) | F.array_contains(words, name)
        found = F.when(hit, name) if found is None else found.when(hit, name)
    return F.coalesce(spelled, found, F.lit("unknown"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with header, optional quotes and blanks trimmed; a row that does not fit is kept in ``_bad``."""
    full = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    return (
        spark.read.schema(full).option("header", True).option("quote", '"').option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad")
        .option("encoding", "UTF-8").csv(path)
    )


def load_counts(csv: DataFrame) -> DataFrame:
    """Rows loaded and rows refused. All columns are read, or a bad value would go unnoticed."""
    row = F.concat_ws("", *[F.col(c).cast("string") for c in csv.columns if c != "_bad"]) >= ""
    return csv.agg(
        F.count_if(F.col("_bad").isNull() & row).alias("loaded"), F.count_if(F.col("_bad").isNotNull() & row).alias("errors")
    )


def parcel_csv(csv: DataFrame, county: str, state: str) -> DataFrame:
    """Parcels of one county and state, compared without regard to case."""
    return csv.where((F.lower(F.trim("county_id")) == county.lower()) & (F.upper(F.trim("state_code")) == state.upper()))


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """County seed file: code, name, state."""
    return spark.read.option("header", True).schema(
        "county_fips string, county_name string, state_code string, state_name string"
    ).csv(path)
