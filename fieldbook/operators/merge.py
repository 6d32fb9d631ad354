"""Table states after merges, replacements, updates, retention and history: pure DataFrame logic.

Each function returns the full new state of the target; :mod:`fieldbook.sources.tables` stores it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.operators.ranking import latest_by


def _key_columns(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """Key names as spelled in the frame; compared without regard to case."""
    by_lower = {c.lower(): c for c in df.columns}
    return [by_lower[k.lower()] for k in keys]


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str] | None = None,
    newest: Sequence[str] | None = None, stamp: dict[str, Column] | None = None,
) -> DataFrame:
    """MERGE: update matched rows, insert the others, keep the rest.

    ``update`` limits the columns a matched row takes from the source. The source is first reduced
    to one row per key, the greatest by ``newest`` (all other columns when not given). ``stamp``
    sets columns on matched rows, such as an update time.
    """
    keys = _key_columns(target, keys)
    order = list(newest) if newest else [c for c in source.columns if c not in keys]
    source = latest_by(source, keys, order) if order else source.dropDuplicates(keys)
    changed = set(update) if update is not None else {c for c in source.columns if c not in keys}
    t, s = target.withColumn("_in_t", F.lit(True)).alias("t"), source.withColumn("_in_s", F.lit(True)).alias("s")
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(f"t.{k}") == F.col(f"s.{k}"))
    joined = t.join(s, cond, "full_outer")
    in_t, in_s = F.col("_in_t").isNotNull(), F.col("_in_s").isNotNull()
    out = []
    for c in target.columns:
        old = F.col(f"t.{c}")
        if c not in source.columns:
            value = old
        elif c in keys:
            value = F.coalesce(old, F.col(f"s.{c}"))
        elif c in changed:
            value = F.when(in_s, F.col(f"s.{c}")).otherwise(old)
        else:
            value = F.when(in_t, old).otherwise(F.col(f"s.{c}"))
        if stamp and c in stamp:
            value = F.when(in_s, stamp[c]).otherwise(value)
        out.append(value.alias(c))
    return joined.select(*out)


def update_only(target: DataFrame, source: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Take the given columns for keys present in the source; nothing is inserted."""
    one = latest_by(source.select(key, *columns), [key], list(columns))
    s = one.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_{c}") for c in columns])
    joined = target.join(s, target[key] == s["_k"], "left")
    hit = F.col("_k").isNotNull()
    return joined.select(*[F.when(hit, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns])


def replace_by_key(old: DataFrame, keys: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Delete all rows of the processed keys, then add the new rows.

    ``keys`` are all processed keys, so a key whose new set is empty loses its old rows too.
    """
    gone = keys.select(key).distinct()
    return old.join(gone, key, "left_anti").unionByName(new, allowMissingColumns=True)


def retained(df: DataFrame, ts: str, as_of: dt.datetime, days: int) -> DataFrame:
    """Rows at least as new as the cut-off; rows without a time are kept."""
    cutoff = F.lit(as_of - dt.timedelta(days=days))
    return df.where(F.col(ts).isNull() | (F.col(ts) >= cutoff))


def removal_report(tables: dict[str, DataFrame], ts: str, as_of: dt.datetime, days: int) -> DataFrame:
    """Rows kept and deleted per table under the retention rule."""
    cutoff = F.lit(as_of - dt.timedelta(days=days))
    out = None
    for name, df in tables.items():
        old = F.count_if(F.col(ts) < cutoff)
        row = df.agg(F.lit(name).alias("table_name"), old.alias("deleted"), (F.count(F.lit(1)) - old).alias("kept"))
        out = row if out is None else out.unionByName(row)
    return out


def without_keys(
    df: DataFrame, key: str, prefix: str | None = None, keys: DataFrame | None = None, expired_before: Column | None = None,
    expiry: str = "ttl",
) -> DataFrame:
    """Rows left after deleting by key prefix, by listed keys, or by expiry time."""
    out = df
    if prefix is not None:
        out = out.where(~F.col(key).startswith(prefix))
    if keys is not None:
        out = out.join(keys.select(key), key, "left_anti")
    if expired_before is not None:
        out = out.where(F.col(expiry) >= expired_before)
    return out


def history(changes: DataFrame, key: str, updated: str) -> DataFrame:
    """Slowly changing history: each version is valid until the next one of its key.

    Versions that share a time collapse to the greatest one, so validity ranges never overlap.
    """
    rest = [c for c in changes.columns if c not in (key, updated)]
    versions = latest_by(changes, [key, updated], rest) if rest else changes.distinct()
    later = F.lead(updated).over(Window.partitionBy(key).orderBy(updated))
    return versions.withColumns({"valid_from": F.col(updated), "valid_to": later}).withColumn(
        "is_current", F.col("valid_to").isNull()
    )
