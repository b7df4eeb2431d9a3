"""The two user-facing jobs as plans over DataFrames, without input or output."""

from parcelgrid.plans.hotspots import hotspots
from parcelgrid.plans.parcels import graded_prospects

__all__ = ["graded_prospects", "hotspots"]
