"""Ranks, running totals and exact quantiles that never funnel a group through one task.

``row_number() over (order by …)`` without a partition key, and ``percentile`` on a large group,
both end in a single task. Here rows are range-partitioned on (keys, order), each slice is numbered
on its own, and the slices are stitched together with per-slice totals, so one key may span any
number of slices. Keys that were counted and found to be of ordinary size are plain windows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.session import cut_lineage, if_small, shuffle_width, written

#: Rows that a window holds at most, and groups of keys by which rows are counted beforehand.
WINDOW_ROWS, KEY_GROUPS = 1_000_000, 65_536


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    cond = F.lit(True)
    for n in names:
        cond = cond & left[n].eqNullSafe(right[n])
    return cond


def running_total(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], weight: str, out: str
) -> DataFrame:
    """Inclusive running sum of ``weight`` within ``keys`` along ``order`` (which must be unique).

    Keys of ordinary size are windows over one shuffle. Rows of keys that may be larger (and all rows where there are no keys)
    are cut into ranges.
    """
    keys = list(keys)
    if not keys:
        return _over_ranges(df, keys, order, weight, out)
    usual, crowded = by_key_size(df, keys)
    upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = usual.withColumn(out, F.sum(weight).over(upto))
    return summed if crowded is None else summed.unionByName(_over_ranges(crowded, keys, order, weight, out))


def by_key_size(df: DataFrame, keys: Sequence[str], most: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Rows of keys that surely have at most ``most`` rows each, and the others, None where there are none.

    Rows are counted by groups of keys, which combine before the shuffle, so a key is never counted as smaller than it is.
    """
    group = F.pmod(F.xxhash64(*keys), F.lit(KEY_GROUPS))
    counts = df.groupBy(group.alias("_group")).agg(F.count(F.lit(1)).alias("_n"))
    large = [r["_group"] for r in counts.where(F.col("_n") > (WINDOW_ROWS if most is None else most)).collect()]
    if not large:
        return df, None
    return df.where(~group.isin(large)), df.where(group.isin(large))


def _over_ranges(df: DataFrame, keys: list[str], order: Sequence[Column], weight: str, out: str) -> DataFrame:
    """``running_total`` over slices of the rows, so that one key may span any number of tasks.

    The ranged rows are written to the shared folder first: range boundaries are sampled, so two
    readings of an unmaterialised range partitioning could disagree.
    """
    width = shuffle_width(df.sparkSession)
    sliced = written(
        df.repartitionByRange(width, *[F.col(k) for k in keys], *order).withColumn("_slice", F.spark_partition_id()), "slices"
    )
    totals = sliced.groupBy("_slice", *keys).agg(F.sum(weight).alias("_total"))
    # One row per slice and key present in it; a key has at most `width` rows here.
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_slice", *keys, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    if not keys:
        starts = F.broadcast(starts)  # exactly `width` rows at most
    within_slice = Window.partitionBy("_slice", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = sliced.withColumn("_local", F.sum(weight).over(within_slice))
    joined = local.join(starts, _same(local, starts, ["_slice", *keys]), "left")
    return joined.select(*[local[c] for c in df.columns], (F.col("_local") + F.col("_start")).alias(out))


def global_rank(df: DataFrame, order: Sequence[Column], out: str, keys: Sequence[str] = ()) -> DataFrame:
    """1-based position along a unique order, over the whole table or within each key."""
    ranked = running_total(df.withColumn("_one", F.lit(1).cast("bigint")), keys, order, "_one", out)
    return ranked.drop("_one")


def dense_rank_desc(df: DataFrame, value: str, out: str) -> DataFrame:
    """Dense rank by descending value: rank the distinct values, then join them back."""
    distinct = global_rank(df.select(F.col(value).alias("_v")).distinct(), [F.desc("_v")], out)
    return df.join(distinct, df[value].eqNullSafe(distinct["_v"]), "left").drop("_v")


def exact_quantiles(
    df: DataFrame, value: str, probs: dict[str, float], keys: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """Exact linearly interpolated quantiles, one column per entry of ``probs``.

    ``weight`` names a column that says how many rows each row stands for.

    Works on (value, count) pairs: repeated values collapse before the shuffle, and the position of
    each value comes from a distributed running count.
    """
    keys = list(keys)
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(
        (F.sum(weight) if weight else F.count(F.lit(1))).alias("_n")
    )
    upto = running_total(counts, keys, [F.col("_v")], "_n", "_hi")
    if keys:
        sizes = upto.groupBy(*keys).agg(F.max("_hi").alias("_size")).select(
            *[F.col(k).alias(f"_k_{k}") for k in keys], "_size"
        )
        cond = F.lit(True)
        for k in keys:
            cond = cond & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        upto = upto.join(sizes, cond).drop(*[f"_k_{k}" for k in keys])
    else:
        upto = upto.withColumn("_size", upto.agg(F.max("_hi")).scalar())
    aggs = []
    for name, p in probs.items():
        pos = (F.col("_size") - 1) * F.lit(float(p))
        for tag, index in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            hit = (index >= F.col("_hi") - F.col("_n")) & (index < F.col("_hi"))
            aggs.append(F.max(F.when(hit, F.col("_v"))).alias(f"_{tag}_{name}"))
        aggs.append(F.max(pos - F.floor(pos)).alias(f"_f_{name}"))
    grouped = upto.groupBy(*keys).agg(*aggs)
    return grouped.select(
        *keys,
        *[
            (F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_f_{n}")).alias(n)
            for n in probs
        ],
    )


def quantile_values(df: DataFrame, value: str, probs: Sequence[float], weight: str | None = None) -> list[float]:
    """A few exact quantiles as numbers: one row comes back to the driver. Empty for an empty column."""
    names = {f"q{i}": p for i, p in enumerate(probs)}
    columns = [value, weight] if weight else [value]
    row = exact_quantiles(df.select(*columns), value, names, weight=weight).first()
    return [] if row is None or row["q0"] is None else [row[n] for n in names]


def _below(value: Column, edges: Sequence[float]) -> Column:
    """How many of the edges lie strictly below the value."""
    return sum((F.when(value > e, 1).otherwise(0) for e in edges), F.lit(0))


def _distinct(edges: Sequence[float]) -> list[float]:
    return sorted(set(edges))


def decile(df: DataFrame, value: str, out: str) -> DataFrame:
    """1..10: one plus the number of inner decile edges strictly below the value (right-closed)."""
    edges = _distinct(quantile_values(df, value, [i / 10 for i in range(1, 10)]))
    v = F.col(value)
    return df.withColumn(out, F.when(v.isNotNull(), _below(v, edges) + 1))


def quantile_bucket(df: DataFrame, value: str, q: int, out: str, first_label: int = 1) -> DataFrame:
    """Equal-frequency buckets; equal edges merge, and merged buckets are numbered without gaps."""
    edges = _distinct(quantile_values(df, value, [i / q for i in range(q + 1)]))
    v = F.col(value)
    return df.withColumn(out, F.when(v.isNotNull(), F.greatest(_below(v, edges), F.lit(1)) - 1 + first_label))


def quantile_or_width_bucket(df: DataFrame, value: str, out: str, labels: Sequence[float]) -> DataFrame:
    """Score by quantile buckets, one per label; when edges coincide use equal widths instead.

    With no more distinct values than labels: 5 above the median, else 3.
    """
    q = len(labels)
    edges = quantile_values(df, value, [*[i / q for i in range(q + 1)], 0.5])
    v = F.col(value)
    if not edges:
        return df.withColumn(out, F.lit(None).cast("double"))
    *edges, median = edges
    if df.select(value).where(v.isNotNull()).distinct().limit(q + 1).count() <= q:
        score = F.when(v > median, 5.0).otherwise(3.0)
    else:
        if len(set(edges)) == q + 1:
            bucket = F.greatest(_below(v, edges), F.lit(1))
        else:
            step = (edges[-1] - edges[0]) / q
            bucket = F.least(F.greatest(F.ceil((v - edges[0]) / step).cast("int"), F.lit(1)), F.lit(q))
        score = F.get(F.array(*[F.lit(float(x)) for x in labels]), bucket - 1)
    return df.withColumn(out, F.when(v.isNotNull(), score))


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """A report limit: per-task heaps, then a merge of n rows per task."""
    return df.orderBy(*order).limit(n)


def top_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """Top n rows of each key. Spark keeps n rows per key on the map side before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).withColumnRenamed("_rn", "rank")


def latest_by(df: DataFrame, keys: Sequence[str], newest: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """One row per key, the greatest by ``newest``, with all columns or those named beside the keys. An aggregate, so hot keys
    shrink before the shuffle."""
    rest = [c for c in (df.columns if columns is None else columns) if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*newest)).alias("_best")
    picked = df.groupBy(*keys).agg(best)
    return picked.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in rest]).select(*[c for c in df.columns if c in keys or c in rest])


def with_group_size(df: DataFrame, key: str, out: str) -> DataFrame:
    """Rows per key as a column; null keys get null.

    Counting first and joining back keeps a hot key spread out: the counts combine on the map side
    and are stored and broadcast while there are few. Shuffled, the rows would end in as many tasks
    as there are keys, or fewer; with many keys that does no harm.
    """
    sizes = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias(out))
    sizes = if_small(cut_lineage(sizes))
    return df.join(sizes, df[key] == sizes["_key"], "left").drop("_key")
