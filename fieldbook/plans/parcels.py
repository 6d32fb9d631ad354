"""Raw documents to curated parcels."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame

from fieldbook.operators.curation import curate_parcels
from fieldbook.operators.staging import stage_parcels


def curated_parcels(
    raw: DataFrame, as_of: dt.datetime | None = None, retention_days: int | None = 90, columns: Sequence[str] | None = None
) -> DataFrame:
    """Scan → flatten → extract → flag → latest per parcel → clean and categorise.

    One shuffle: the aggregate that keeps the newest record of each parcel.
    """
    return curate_parcels(stage_parcels(raw, as_of, retention_days, columns), as_of, columns)
