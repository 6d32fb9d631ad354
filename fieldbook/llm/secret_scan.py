"""Secrets in text, judged by how many owners and repositories hold the same value across the corpus.

Candidates are found row by row with regular expressions of the JVM; only their positions and value hashes leave the scan. A
value that several owners hold is a copied example; a varied value that a single owner holds looks live and gets a span of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.llm.common import landed

#: Kind, pattern, group that holds the value. The letters of the keywords stand in either case.
KINDS = [
    (
        "assign",
        r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
        r"|[aA][pP][iI]_?[kK][eE][yY])[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?([A-Za-z0-9+/_.=-]+)",
        2,
    ),
    ("access", r"AKIA[A-Z0-9]{16,}", 0),  # the same as AKIA[A-Z0-9]+ with 20 or more characters: a shorter run holds no longer one
    ("hex", r"[0-9a-f]{24,}", 0),
]
LIVE = "live"
LEAST_ASSIGNED = 6
SALTS = 16


def _found(text: Column, number: int) -> Column:
    """For one kind: gap before each match, its length, length and hash of its value, and whether the value is varied."""
    _, pattern, group = KINDS[number]
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    described = F.transform(
        F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), value.alias("value")),
        lambda x: F.struct(
            F.lit(number).alias("kind"),
            x["gap"].alias("gap"),
            F.length(x["whole"]).alias("size"),
            F.length(x["value"]).alias("value_size"),
            F.sha2(x["value"], 256).alias("key"),
            (F.size(F.array_distinct(F.split(x["value"], ""))) >= 8).alias("varied"),
        ),
    )
    described = F.filter(described, lambda x: x["size"].isNotNull())  # the last gap has no match after it
    return F.when(text.rlike(pattern), described)


def scan(df: DataFrame, id_col: str, text_col: str, owner: Column, repository: Column) -> DataFrame:
    """One row per row of ``df`` without its text: ``_row``, ``_id``, ``_owner``, ``_repository``, and ``_found``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(id_col).alias("_id"),
        F.xxhash64(text).alias("_text_hash"),
        F.coalesce(owner.cast("string"), F.lit("")).alias("_owner"),
        F.coalesce(repository.cast("string"), F.lit("")).alias("_repository"),
        *[_found(text, n).alias(f"_{kind}") for n, (kind, _, _) in enumerate(KINDS)],
    )
    return landed(rows, "secrets")


def spans(scanned: DataFrame) -> DataFrame:
    """Candidates with positions in code points, the end exclusive."""
    kinds = [f"_{kind}" for kind, _, _ in KINDS]
    each = [
        scanned.where(F.col(k).isNotNull()).select("_row", "_owner", "_repository", "_text_hash", F.posexplode(k).alias("_at", "_m")) for k in kinds
    ]
    rows = each[0].unionByName(each[1]).unionByName(each[2]).select("_row", "_owner", "_repository", "_text_hash", "_at", "_m.*")
    before = Window.partitionBy("_row", "kind").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(before))
        .where((F.col("kind") != 0) | (F.col("value_size") >= LEAST_ASSIGNED))
        .withColumn("start", F.col("end") - F.col("size"))
    )


def ownership(candidates: DataFrame) -> DataFrame:
    """``key``, and in how many distinct owners and repositories it stands.

    Texts are counted, not rows: a mirrored text belongs to the first of its owners and repositories, so a copy of a whole
    document tells nothing about the values in it. Copies collapse before each shuffle.
    """
    homes = candidates.groupBy("key", "_text_hash").agg(F.min(F.struct("_owner", "_repository")).alias("_home"))
    held = homes.groupBy("key", F.col("_home._owner").alias("_owner"), F.col("_home._repository").alias("_repository")).agg(F.lit(1).alias("_one"))
    by_owner = held.groupBy("key", "_owner").agg(F.count("*").alias("_repositories"))
    return by_owner.groupBy("key").agg(F.count("*").alias("n_owners"), F.sum("_repositories").alias("n_repositories"))


def find_secrets(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner: Column | None = None,
    repository: Column | None = None,
    example_owners: int = 2,
    example_repositories: int = 3,
) -> DataFrame:
    """Candidates of every whole text and what the corpus says about them.

    Returns one row per row of ``df``: id_col; ``text_hash``, which tells apart texts under one id; ``found``, an array of (start, rank, end, kind, key, n_owners, n_repositories,
    judged) ordered by start and kind, where ``judged`` is ``example`` for a value that stands in different texts of
    ``example_owners`` or more owners or ``example_repositories`` or more repositories, ``live`` for another varied value, and
    ``plain`` otherwise. A live candidate adds an entry of kind ``live`` that
    covers its value alone. A repository is (owner, repository). Null texts are empty and have no candidates; a null owner or
    repository counts as one unnamed owner or repository; repeated rows and equal or null ids are kept apart by an own row number.
    """
    owner = F.lit("") if owner is None else owner
    scanned = scan(df, id_col, text_col, owner, owner if repository is None else repository)
    base = spans(scanned)
    copied = (F.col("n_owners") >= example_owners) | (F.col("n_repositories") >= example_repositories)
    judged = F.when(copied, "example").when(F.col("varied"), LIVE).otherwise("plain")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    known = ownership(base).withColumn("_salt", salts)  # a widely copied value is met in SALTS tasks
    names = F.array(*[F.lit(k) for k, _, _ in KINDS])
    rows = base.withColumn("_salt", F.pmod("_row", F.lit(SALTS)).cast("int")).join(known, ["key", "_salt"]).withColumn("judged", judged)
    entry = F.struct(
        "start", F.col("kind").alias("rank"), "end", F.element_at(names, F.col("kind") + 1).alias("kind"),
        "key", "n_owners", "n_repositories", "judged",
    )
    own = F.struct(
        (F.col("end") - F.col("value_size")).alias("start"), F.lit(len(KINDS)).alias("rank"), "end", F.lit(LIVE).alias("kind"),
        "key", "n_owners", "n_repositories", "judged",
    )
    rows = rows.select("_row", F.explode(F.when(F.col("judged") == LIVE, F.array(entry, own)).otherwise(F.array(entry))).alias("_e"))
    # two kinds may hold one value: its live span stands once
    by_row = rows.groupBy("_row").agg(F.array_sort(F.collect_set("_e")).alias("found"))
    some = F.lit(False)
    for kind, _, _ in KINDS:
        some = some | F.col(f"_{kind}").isNotNull()
    empty = F.array().cast(by_row.schema["found"].dataType)
    with_some = scanned.where(some).join(by_row, "_row", "left").select(F.col("_id").alias(id_col), F.col("_text_hash").alias("text_hash"), F.coalesce("found", empty).alias("found"))
    without = scanned.where(~some).select(F.col("_id").alias(id_col), F.col("_text_hash").alias("text_hash"), empty.alias("found"))
    return with_some.unionByName(without)


def masked(text: Column, found: Column) -> Column:
    """The text with stars in place of its live values; positions stay."""
    live = F.filter(found, lambda x: x["kind"] == LIVE)
    cover = lambda t, x: F.concat(
        F.substring(t, F.lit(1), x["start"].cast("int")),
        F.repeat(F.lit("*"), (x["end"] - x["start"]).cast("int")),
        F.substring(t, (x["end"] + 1).cast("int"), F.length(t)),
    )
    return F.aggregate(live, text, cover)


def listed(found: Column, base_only: bool = False) -> Column:
    """kind:start:end of each entry, comma-joined."""
    entries = F.filter(found, lambda x: x["rank"] < len(KINDS)) if base_only else found
    return F.array_join(F.transform(entries, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def counted(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda x: x["kind"] == kind)).cast("bigint")
