"""Helpers shared by the text operators: reading tables, landing intermediate tables, folds, batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.session import new_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def landed(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet below the shared folder and read again: cuts the lineage and survives lost executors."""
    folder = new_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


#: Tables of ids or keys (8 to 40 bytes a row) are broadcast up to this number of rows; beyond it they are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def sized(df: DataFrame) -> DataFrame:
    """A written table, marked for broadcast where it has at most BROADCAST_ROWS rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def share_drawn(hashed: Column, most: int, count: int) -> Column:
    """True for about ``most`` of ``count`` rows, told by a 64-bit hash of each, however many rows there are."""
    if count <= most:
        return F.lit(True)
    return hashed < F.lit(int(most / count * 2.0**64) - 2**63)


def training_fold(doc_id: Column) -> Column:
    """True for rows whose labels may be learnt: crc32 of the id as text, modulo 3, is not 1. A null id is never used."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 != 1, F.lit(False))


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text, modulo 3, is 1 (a null id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def map_batches(df: DataFrame, schema: str, fn: Callable[[pa.RecordBatch], dict]) -> DataFrame:
    """Apply ``fn`` to Arrow batches; it returns the columns of ``schema`` by name as lists or arrays."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = fn(batch)
            yield pa.RecordBatch.from_arrays(
                [c.cast(f.type) if isinstance(c := columns[f.name], pa.Array) else pa.array(c, type=f.type) for f in arrow], schema=arrow
            )

    return df.mapInArrow(run, schema)
