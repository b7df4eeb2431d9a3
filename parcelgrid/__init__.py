"""Spatial hotspots and parcel enrichment on Spark."""
