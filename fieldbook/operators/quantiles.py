"""Exact quantiles of each group beside its other statistics, without sorting or ranging rows.

An ordinary group's quantiles are an aggregate like any other: counts of its values are combined before the shuffle. A group
of very many rows would need one task with all its values, so its wanted positions are narrowed round by round instead:
its range is cut into buckets, rows are counted per bucket (which combines), and the bucket that holds the position becomes the
next range, until that range is one value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.session import cut_lineage, if_small

#: Rows from which a group counts as large, and buckets that a range is cut into.
LARGE, BUCKETS = 200_000, 4096


def _alike(left: DataFrame, right: DataFrame, names: Sequence[str], prefix: str = "_k_") -> tuple[DataFrame, Column]:
    """``right`` with its keys renamed, and the null-safe condition that joins it to ``left``."""
    renamed = right.withColumnsRenamed({n: f"{prefix}{n}" for n in names})
    cond = F.lit(True)
    for n in names:
        cond = cond & F.col(n).eqNullSafe(F.col(f"{prefix}{n}"))
    return renamed, cond


def with_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float], aggregates: Sequence[Column] = (), large: int = LARGE) -> DataFrame:
    """One row for each group of ``keys``: the aggregates, and linearly interpolated quantiles of ``value`` by name.

    Null values are left out of the quantiles; a group without values has null ones. Null keys are a group like any other.
    """
    keys, v = list(keys), F.col(value).cast("double")
    sizes = df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(v).alias("_low"), F.max(v).alias("_high"))
    crowds = cut_lineage(sizes.where(F.col("_n") > large))
    quantile = lambda x: [F.percentile(x, F.lit(float(p))).alias(name) for name, p in probs.items()]
    if crowds.isEmpty():
        return df.groupBy(*keys).agg(*aggregates, *quantile(v))
    crowds = if_small(crowds)
    known, cond = _alike(df, crowds.select(*keys, F.lit(True).alias("_large")), keys)
    flagged = df.join(known, cond, "left").drop(*[f"_k_{k}" for k in keys])
    out = flagged.groupBy(*keys).agg(*aggregates, *quantile(F.when(F.col("_large").isNull(), v)))
    found, cond = _alike(out, _narrowed(df.select(*keys, v.alias("_v")), keys, crowds, probs).withColumnsRenamed({n: f"_q_{n}" for n in probs}), keys)
    joined = out.join(if_small(cut_lineage(found)), cond, "left")
    return joined.select(*[c for c in out.columns if c not in probs], *[F.coalesce(f"_q_{n}", n).alias(n) for n in probs])


def _narrowed(rows: DataFrame, keys: list[str], crowds: DataFrame, probs: dict[str, float]) -> DataFrame:
    """Quantiles of large groups. A state row is one position of one group: its rank in the range that still holds it."""
    wanted = []
    for name, p in probs.items():
        place = (F.col("_n") - 1) * F.lit(float(p))
        wanted += [
            F.struct(F.lit(name).alias("name"), F.lit(side).alias("side"), rank.cast("bigint").alias("rank"), (place - F.floor(place)).alias("part"))
            for side, rank in (("low", F.floor(place)), ("high", F.ceil(place)))
        ]
    state = crowds.withColumn("_w", F.explode(F.array(*wanted))).select(*keys, "_w.*", F.col("_low").alias("low"), F.col("_high").alias("high"))
    done, state = [], cut_lineage(state)
    of_state = [*keys, "name", "side", "rank", "part"]
    while True:
        done.append(state.where("low = high"))
        state = state.where("low < high")
        if state.isEmpty():
            break
        open_, cond = _alike(rows, if_small(state), keys)
        inside = rows.join(open_, cond & F.col("_v").between(F.col("low"), F.col("high"))).drop(*keys).withColumnsRenamed({f"_k_{k}": k for k in keys})
        # Never falls as the value grows, and parts the least value of a range from the greatest, so every round narrows.
        bucket = F.least(F.floor((F.col("_v") - F.col("low")) / (F.col("high") - F.col("low")) * BUCKETS), F.lit(BUCKETS - 1))
        counts = inside.groupBy(*of_state, bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("low"), F.max("_v").alias("high"))
        upto = F.sum("_c").over(Window.partitionBy(*of_state).orderBy("_b"))
        held = counts.withColumn("_upto", upto).where((F.col("rank") < F.col("_upto")) & (F.col("rank") >= F.col("_upto") - F.col("_c")))
        state = cut_lineage(held.withColumn("rank", F.col("rank") - (F.col("_upto") - F.col("_c"))).select(*of_state, "low", "high"))
    ends = done[0]
    for more in done[1:]:
        ends = ends.unionByName(more)
    at = lambda name, side: F.max(F.when((F.col("name") == name) & (F.col("side") == side), F.col("low")))
    part = lambda name: F.max(F.when(F.col("name") == name, F.col("part")))
    return ends.groupBy(*keys).agg(*[(at(n, "low") + (at(n, "high") - at(n, "low")) * part(n)).alias(n) for n in probs])
