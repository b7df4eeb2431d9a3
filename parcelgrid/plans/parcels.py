"""Prospects graded by the parcel that holds them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation

from parcelgrid.operators import enrich


def graded_prospects(
    prospects: DataFrame,
    parcels: DataFrame,
    limit: int | None = None,
    observation: Observation | None = None,
) -> DataFrame:
    """The 13 output columns per prospect; see ``operators.enrich.enrich``."""
    return enrich(prospects, parcels, limit=limit, observation=observation)
