"""Water rights: which parcels can be asked about, and what was found around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.functions.values import first_match, two_letter_state
from fieldbook.operators.ranking import global_rank
from fieldbook.session import cut_lineage, if_small

SUPPORTED_STATES = ["CO"]


def gate(state: Column, lat: Column, lon: Column, supported: list[str] | None = None) -> Column:
    """Why a parcel cannot be looked up, or null when it can."""
    code = two_letter_state(state)
    served = F.coalesce(code.isin(supported or SUPPORTED_STATES), F.lit(False))
    return first_match([(~served, "state_not_supported"), (lat.isNull() | lon.isNull(), "no_coordinates")])


def ranked(rights: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rights with the place (``seniority``) of each dated one by date and structure, and the table of these places."""
    names = ["appropriation_date", "structure_name"]
    places = cut_lineage(global_rank(rights.where(F.col(names[0]).isNotNull()).select(*names).distinct(), [F.col(n) for n in names], "seniority"))
    own = if_small(places.select("seniority", F.col(names[0]).alias("_date"), F.col(names[1]).alias("_structure")))
    same = (F.col(names[0]) == F.col("_date")) & F.col(names[1]).eqNullSafe(F.col("_structure"))
    return rights.join(own, same, "left").drop("_date", "_structure"), places


def summarise(rights: DataFrame, key: str = "parcel_id", places: DataFrame | None = None) -> DataFrame:
    """Count, earliest appropriation with its structure, and the sorted sources.

    With the ``places`` of ``ranked`` the pairs of parcels and rights collapse in a hash table as they are found, since a place is
    a number; without them every pair is sorted.
    """
    sources = F.sort_array(F.collect_set("water_source")).alias("water_sources")
    if places is not None:
        few = rights.groupBy(key, "water_source").agg(F.count(F.lit(1)).alias("n"), F.min("seniority").alias("seniority"))
        out = few.groupBy(key).agg(F.sum("n").alias("rights_count"), F.min("seniority").alias("seniority"), sources)
        return out.join(if_small(places), "seniority", "left").select(
            key, "rights_count", F.col("appropriation_date").alias("most_senior_priority_date"),
            F.col("structure_name").alias("most_senior_structure"), "water_sources",
        )
    dated = F.col("appropriation_date").isNotNull()
    return rights.groupBy(key).agg(
        F.count(F.lit(1)).alias("rights_count"),
        F.min("appropriation_date").alias("most_senior_priority_date"),
        F.min(F.when(dated, F.struct("appropriation_date", "structure_name")))["structure_name"].alias("most_senior_structure"),
        sources,
    )


def status(parcels: DataFrame, rights: DataFrame, supported: list[str] | None = None, places: DataFrame | None = None) -> DataFrame:
    """One row per parcel: availability, reason, and the summary where rights were found."""
    reason = gate(F.col("state_code"), F.col("latitude"), F.col("longitude"), supported)
    out = parcels.withColumn("_gate", reason).join(summarise(rights, places=places), "parcel_id", "left")
    found = F.col("_gate").isNull() & F.col("rights_count").isNotNull()
    return out.withColumns(
        {
            "available": found,
            "reason": F.coalesce("_gate", F.when(found, "ok").otherwise("no_rights_found")),
        }
    ).drop("_gate")
