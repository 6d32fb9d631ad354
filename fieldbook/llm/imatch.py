"""I-Match fingerprints: terms within a band of inverse document frequency, sorted, hashed under randomised lexicon subsets.

All of it is column work: a text is cut, its terms are filtered by the lexicon and hashed in the row itself. Only the document
frequencies, and the texts of neighbours where a caller wants them together, are shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.common import landed

#: Band of natural-log inverse document frequency. A kept term stands in at least N * exp(-IDF_MOST) documents, so the lexicon
#: has at most exp(IDF_MOST) times the mean number of distinct terms of a document, whatever N is.
IDF_LEAST, IDF_MOST = 0.7, 6.0
#: Random subsets of the lexicon: (one term in so many is drawn, number of such subsets). The first hash is of the whole lexicon.
SUBSETS = ((16, 8), (64, 14), (256, 14))
#: A lexicon up to this size is carried in the expression; a larger one is joined.
INLINE_TERMS = 400_000
SLOTS = 8


@dataclass
class Lexicon:
    """Hashes of the kept terms: as a column of buckets, or as a table where they are too many."""

    buckets: Column | None
    n_buckets: int
    terms: DataFrame


def words(text: Column) -> Column:
    """Distinct lower-case terms between white space and punctuation."""
    return F.array_remove(F.array_distinct(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\s\p{Punct}]+")), "")


def document_frequencies(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``term`` (64-bit hash) and in how many rows it stands, over the whole table."""
    return df.select(F.explode(words(F.col(text_col))).alias("_w")).select(F.xxhash64("_w").alias("term")).groupBy("term").agg(F.count("*").alias("n"))


def lexicon(df: DataFrame, text_col: str = "text", idf_least: float = IDF_LEAST, idf_most: float = IDF_MOST) -> Lexicon:
    """Terms of ``df`` whose inverse document frequency lies in the band."""
    total = df.count()
    counts = document_frequencies(df, text_col)
    idf = F.log(F.lit(float(max(total, 1))) / F.col("n"))
    kept = landed(counts.where(idf.between(idf_least, idf_most)).select("term"), "lexicon")
    size = kept.count()
    if size > INLINE_TERMS:
        return Lexicon(None, 0, kept)
    hashes = [r.term for r in kept.collect()]
    n_buckets = max(1, size)
    while True:
        table: list[list[int]] = [[] for _ in range(n_buckets)]
        for h in hashes:
            table[h % n_buckets].append(h)
        if max(map(len, table)) <= SLOTS:
            break
        n_buckets *= 2
    flat = ",".join(str(h) for b in table for h in b + [0] * (SLOTS - len(b)))
    return Lexicon(F.split(F.lit(flat), ",").cast("array<bigint>"), n_buckets, kept)


def with_kept(df: DataFrame, text_col: str, lexicon: Lexicon, out: str) -> DataFrame:
    """Adds the terms of ``text_col`` that are in the lexicon, sorted, as hashes; a text with none there keeps all its terms."""
    terms = F.array_sort(words(F.col(text_col)))
    hashes = F.transform(terms, lambda w: F.xxhash64(w))
    if lexicon.buckets is not None:
        place = lambda h: (F.pmod(h, F.lit(lexicon.n_buckets)) * SLOTS + 1).cast("int")
        kept = F.filter(hashes, lambda h: F.array_contains(F.slice(lexicon.buckets, place(h), F.lit(SLOTS)), h))
        return df.withColumn(out, F.when(F.size(kept) > 0, kept).otherwise(hashes))
    rows = landed(df.withColumn("_r", F.monotonically_increasing_id()), "terms")
    each = rows.select("_r", F.posexplode(hashes).alias("_at", "term")).join(lexicon.terms, "term")
    found = each.groupBy("_r").agg(F.array_sort(F.collect_list(F.struct("_at", "term"))).alias("_k"))
    joined = rows.join(found, "_r", "left").withColumn(out, F.coalesce(F.transform("_k", lambda x: x["term"]), hashes))
    return joined.drop("_r", "_k")


def with_signature(df: DataFrame, kept: str, out: str) -> DataFrame:
    """Adds the hashes of the kept terms under the whole lexicon and under each subset; null where a subset holds none.

    For each size of subsets a further hash of a term draws a number below ``one_in``; subset s holds the terms that drew s.
    Terms that no subset of that size holds are put aside once.
    """
    hashes, levels = [F.when(F.size(kept) > 0, F.xxhash64(kept))], {}
    for i, (one_in, number) in enumerate(SUBSETS):
        drawn = F.transform(kept, _draw(i, one_in))
        levels[f"_level{i}"] = F.filter(drawn, _below(number))
        for s in range(number):
            subset = F.transform(F.filter(f"_level{i}", _is(s)), lambda x: x["h"])
            hashes.append(F.when(F.size(subset) > 0, F.xxhash64(subset)))
    return df.withColumns(levels).withColumn(out, F.array(*hashes)).drop(*levels)


def _draw(seed: int, one_in: int):
    return lambda h: F.struct(h.alias("h"), F.xxhash64(h, F.lit(seed)).bitwiseAND(F.lit(one_in - 1)).alias("s"))


def _below(number: int):
    return lambda x: x["s"] < number


def _is(number: int):
    return lambda x: x["s"] == number


def fingerprints(df: DataFrame, lexicon: Lexicon, text_col: str = "text", out: str = "signature") -> DataFrame:
    """``df`` with the fingerprint of every whole text as an array of hashes.

    Null and empty texts have no terms: all their hashes are null, and two of them are alike. Equal texts have equal
    fingerprints whatever their other columns; rows are never dropped or merged.
    """
    return with_signature(with_kept(df, text_col, lexicon, "_kept"), "_kept", out).drop("_kept")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among those where either text has terms; 1 where neither has any."""
    either = F.size(F.filter(F.zip_with(a, b, lambda x, y: F.coalesce(x, y)), lambda x: x.isNotNull()))
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: F.coalesce(x, F.lit(False))))
    return F.when(either > 0, equal / either).otherwise(F.lit(1.0))


def as_text(hashes: Column) -> Column:
    """Eight hexadecimal digits of each hash, the whole lexicon's first with sixteen; dashes where there is no hash."""
    short = F.transform(F.slice(hashes, 2, 1000), lambda h: F.coalesce(F.lpad(F.lower(F.hex(F.shiftrightunsigned(h, 32))), 8, "0"), F.lit("-")))
    return F.concat(F.coalesce(F.lpad(F.lower(F.hex(F.element_at(hashes, 1))), 16, "0"), F.lit("-")), F.lit(":"), F.array_join(short, ""))
