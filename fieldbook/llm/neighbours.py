"""The next row of a table in the order of its ids, with one shuffle of the rows and no task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.session import shuffle_width

BLOCK, IS_COPY = "_block", "_is_copy"
#: Blocks of ids for each shuffle partition: hashing them to partitions then deals evenly enough.
BLOCKS_PER_PARTITION = 6


def block_starts(df: DataFrame, id_col: str) -> list:
    """First id of each of many ranges of about equal numbers of rows; one value for each range, found over the ids alone."""
    n = shuffle_width(df.sparkSession) * BLOCKS_PER_PARTITION
    ranged = df.select(id_col).where(F.col(id_col).isNotNull()).repartitionByRange(n, id_col)
    firsts = ranged.groupBy(F.spark_partition_id().alias("_p")).agg(F.min(id_col).alias("first"))
    return sorted({r["first"] for r in firsts.collect()})


def with_next(df: DataFrame, id_col: str, value_col: str, out: str) -> DataFrame:
    """Adds the value of the next row (ascending id, then value; after the last row: the first).

    The rows go to blocks of neighbouring ids. The first rows of a block go to the block before as well, marked ``_is_copy``,
    so that its last row finds them; a caller may look one row ahead with ``following`` before it drops the copies. Null ids
    come first. An empty table stays empty.
    """
    starts = block_starts(df, id_col)
    has_null = df.where(F.col(id_col).isNull()).limit(1).count() > 0
    lows = F.array(*[F.lit(s) for s in starts]) if starts else F.array(F.lit(None).cast(df.schema[id_col].dataType))
    size, steps = len(starts), []
    step = 1 << max(size, 1).bit_length()
    while step:
        steps.append(step)
        step >>= 1
    # binary search: the number of starts that are not above the id, so block 1 is that of the first start, 0 that of nulls
    reach = lambda at, by: F.when(
        (at + by <= size) & (F.get(lows, at + by - 1) <= F.col(id_col)), at + by
    ).otherwise(at)
    block = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), reach) if size else F.lit(0)
    opens = F.array_contains(lows, F.col(id_col)) if size else F.lit(False)
    before = F.col(BLOCK) - 1
    if not has_null:
        before = F.when(F.col(BLOCK) == 1, size).otherwise(before)
    elif size:  # nulls are the first block, and come after the last one
        opens, before = opens | F.col(id_col).isNull(), F.when(F.col(BLOCK) == 0, size).otherwise(before)
    else:
        opens, before = F.lit(True), F.lit(0)
    own = F.struct(F.col(BLOCK).alias("b"), F.lit(False).alias("c"))
    again = F.struct(before.cast("int").alias("b"), F.lit(True).alias("c"))
    opens = F.coalesce(opens, F.lit(False))
    spread = df.withColumn(BLOCK, block).withColumn("_to", F.explode(F.when(opens, F.array(own, again)).otherwise(F.array(own))))
    spread = spread.withColumn(BLOCK, F.col("_to.b")).withColumn(IS_COPY, F.col("_to.c")).drop("_to")
    return spread.withColumn(out, F.lead(value_col).over(in_order(id_col, value_col)))


def in_order(id_col: str = "doc_id", value_col: str = "text"):
    return Window.partitionBy(BLOCK).orderBy(IS_COPY, F.col(id_col).asc_nulls_first(), value_col)


def following(name: str, id_col: str = "doc_id", value_col: str = "text") -> Column:
    """Another column of the next row, over rows that ``with_next`` has dealt out."""
    return F.lead(name).over(in_order(id_col, value_col))
