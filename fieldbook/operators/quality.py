"""Data-quality checks, load monitoring, alerts and profiles.

Checks on one table are expressed as aggregates and share one scan; a check that needs the failing
rows returns them as a table, which can be stored.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.functions.values import first_match


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, nulls, total) for every column, from one pass."""
    one = df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(c).isNull()).alias(f"_{c}") for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_{c}").alias("nulls")) for c in columns])
    return one.select("total", F.inline(pairs))


def null_coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Filled share in percent per column; null for an empty table."""
    out = null_counts(df, columns)
    share = (F.col("total") - F.col("nulls")) * 100 / F.nullif(F.col("total"), F.lit(0))
    return out.select("column", "total", F.round(share, 1).alias("filled_percent"))


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def not_accepted(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose value is set but not in the list."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))


def out_of_range(df: DataFrame, column: str, low, high) -> DataFrame:
    return df.where(~F.col(column).between(low, high))


def failing(df: DataFrame, condition: Column) -> DataFrame:
    """Rows on which the condition is false or unknown."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def orphans(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose key has no parent."""
    keys = parent.select(F.col(parent_key).alias("_p"))
    return df.where(F.col(key).isNotNull()).join(keys, df[key] == keys["_p"], "left_anti")


def freshness(df: DataFrame, ts: str, as_of: dt.datetime, warn_hours: int, error_hours: int, by: Sequence[str] = ()) -> DataFrame:
    """Newest row and pass / warn / error by its age."""
    newest = df.groupBy(*by).agg(F.max(ts).alias("newest"))
    age = (F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros(F.col("newest").cast("timestamp"))) / 3.6e9
    status = first_match(
        [(F.col("newest").isNull(), "error"), (F.lit(error_hours) < age, "error"), (F.lit(warn_hours) < age, "warn")], "pass"
    )
    return newest.withColumns({"age_hours": age, "status": status})


def run_checks(df: DataFrame, checks: dict[str, Column], severity: dict[str, str] | None = None) -> DataFrame:
    """One row per named row-level condition: rows failing it, and pass / warn / error. One scan."""
    one = df.agg(*[F.count_if(~F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()])
    rows = F.array(
        *[
            F.struct(
                F.lit(n).alias("check"), F.col(n).alias("failures"),
                F.when(F.col(n) == 0, "pass").otherwise((severity or {}).get(n, "error")).alias("status"),
            )
            for n in checks
        ]
    )
    return one.select(F.inline(rows))


def failing_rows(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Every failing row once per failed check, to be stored under the check's name."""
    failed = F.array_compact(
        F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in checks.items()])
    )
    return df.withColumn("check", F.explode(failed))


def load_quality(raw: DataFrame, has_parcels: Column, has_error: Column, as_of: dt.datetime, days: int = 7) -> DataFrame:
    """Loads per day, type and county: totals, valid and failed records, average size, first and last time."""
    start = dt.datetime.combine(as_of.date() - dt.timedelta(days=days), dt.time())
    ts = F.col("ingestion_timestamp")
    return (
        raw.where(ts >= F.lit(start))
        .groupBy(F.to_date(ts).alias("ingestion_date"), "ingestion_type", "county")
        .agg(
            F.count(F.lit(1)).alias("total_records"),
            F.count_if(has_parcels).alias("valid_parcel_records"),
            F.count_if(has_error).alias("error_records"),
            F.avg("parcel_count").alias("avg_parcels_per_file"),
            F.min(ts).alias("first_ingestion"),
            F.max(ts).alias("last_ingestion"),
        )
    )


def error_alerts(quality: DataFrame, by: Sequence[str] = ("county",), limit_percent: float = 5.0) -> DataFrame:
    """An alert for every group whose error rate is above the limit."""
    sums = quality.groupBy(*by).agg(F.sum("error_records").alias("errors"), F.sum("total_records").alias("total"))
    rated = sums.where("total > 0").withColumn("error_rate", F.col("errors") / F.col("total") * 100)
    text = F.concat(
        F.lit("High error rate detected: "), F.round("error_rate", 2).cast("string"), F.lit("% errors in "),
        F.concat_ws("/", *by), F.lit(" data"),
    )
    return rated.where(F.col("error_rate") > limit_percent).withColumns(
        {
            "alert_type": F.lit("PARCEL_DATA_QUALITY"),
            "alert_message": text,
            "severity": F.when(F.col("error_rate") > 10, "CRITICAL").otherwise("WARNING"),
        }
    )


def county_thresholds(quality: DataFrame, max_error_percent: float = 5.0, min_records: int = 100) -> DataFrame:
    """Counties that break the declared limits, with the reason."""
    sums = quality.groupBy("county").agg(F.sum("error_records").alias("errors"), F.sum("total_records").alias("total"))
    rate = F.col("errors") / F.col("total") * 100
    reason = F.when(rate > max_error_percent, "error_rate").when(F.col("total") < min_records, "too_few_records")
    return sums.withColumn("reason", reason).where(F.col("reason").isNotNull())


def table_check(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row: row count, required columns present, overall status."""
    missing = sorted({c.lower() for c in required} - {c.lower() for c in df.columns})
    rows = df.agg(F.count(F.lit(1)).alias("n"))
    return rows.select(
        F.col("n").alias("row_count"), (F.col("n") > 0).alias("has_rows"), F.lit(",".join(missing)).alias("missing_columns"),
        F.when((F.col("n") > 0) & F.lit(not missing), "pass").otherwise("fail").alias("status"),
    )


def key_presence(df: DataFrame, doc: str) -> DataFrame:
    """How many documents carry each top-level key."""
    keys = F.explode(F.json_object_keys(F.to_json(F.col(doc)))).alias("key")
    return df.select(keys).groupBy("key").agg(F.count(F.lit(1)).alias("documents"))


def field_types(df: DataFrame, doc: str) -> DataFrame:
    """Presence, nulls and value types of every top-level field of a VARIANT column."""
    parts = df.select(F.explode(F.from_json(F.to_json(F.col(doc)), "map<string,string>")).alias("key", "text"), F.col(doc).alias("_d"))
    value = F.try_parse_json("text")
    kind = F.coalesce(F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0), F.lit("STRING"))
    kind = F.when(F.col("text").isNull(), "VOID").otherwise(kind)
    return parts.groupBy("key").agg(
        F.count(F.lit(1)).alias("present"),
        F.count_if(kind == "VOID").alias("nulls"),
        F.array_join(F.sort_array(F.collect_set(kind)), ",").alias("types"),
    )


def coverage(profile: DataFrame) -> DataFrame:
    """Total rows, rows with coordinates, distinct states, and a warning below half coverage."""
    located = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    out = profile.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(located).alias("with_coordinates"),
        F.countDistinct("state_code").alias("states"),
    )
    return out.withColumn("low_coverage", F.col("with_coordinates") < F.col("total") * 0.5)


def frame_report(df: DataFrame, key: str, required: Sequence[str]) -> DataFrame:
    """Row, column and null counts, duplicate ids, all-null columns, required columns over half null."""
    columns = df.columns
    ids = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col(key).isNotNull())
    repeated = ids.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_ids")).select("duplicate_ids")
    one = df.agg(F.count(F.lit(1)).alias("total_rows"), *[F.count_if(F.col(c).isNull()).alias(f"_{c}") for c in columns])
    total = F.col("total_rows")

    def listing(names, cond):
        return F.array_join(F.array_compact(F.array(*[F.when(cond(F.col(f"_{c}")), F.lit(c)) for c in names])), ",")

    return one.select(
        "total_rows", F.lit(len(columns)).alias("total_columns"),
        sum((F.col(f"_{c}") for c in columns), F.lit(0)).alias("null_values"),
        listing(columns, lambda n: (n == total) & (total > 0)).alias("empty_columns"),
        listing([c for c in required if c in columns], lambda n: n > total * 0.5).alias("sparse_required"),
    ).withColumn("duplicate_ids", repeated.scalar())


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, deviation, range and missing share of numeric columns; one pass."""
    aggs = []
    for c in columns:
        v = F.col(c).cast("double")
        stats = F.struct(
            F.lit(c).alias("column"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"),
            F.max(v).alias("max"), (F.count_if(v.isNull()) / F.count(F.lit(1))).alias("missing_rate"),
        )
        aggs.append(stats.alias(f"_{c}"))
    return df.agg(*aggs).select(F.inline(F.array(*[F.col(f"_{c}") for c in columns])))


def categorical_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values, most frequent value (lowest on ties) and missing share of text columns."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    counts = df.select(F.inline(pairs)).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    known = F.col("value").isNotNull()
    return counts.groupBy("column").agg(
        F.count_if(known).alias("unique_values"),
        F.min_by(F.col("value"), F.struct(F.when(known, -F.col("n")).otherwise(F.lit(1)), F.col("value"))).alias("most_frequent"),
        (F.sum(F.when(known, 0).otherwise(F.col("n"))) / F.sum("n")).alias("missing_rate"),
    )


def column_listing(df: DataFrame) -> DataFrame:
    """Columns and types of a table, in order."""
    schema = "position int, column_name string, data_type string"
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, schema)


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    have = {c.lower() for c in df.columns}
    return [c for c in required if c.lower() not in have]


def with_missing_as_zero(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Add absent numeric feature columns as 0, as the scoring step expects."""
    return df.withColumns({c: F.lit(0.0) for c in missing_columns(df, required)})
