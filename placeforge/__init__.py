"""Ranked, de-duplicated geo-objects from raw geocoder place rows, on Spark."""

from placeforge.plans.elems import build_elems
from placeforge.plans.serve import query_area

__all__ = ["build_elems", "query_area"]
