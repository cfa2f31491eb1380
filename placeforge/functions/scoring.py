"""Importance scores."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_FACTOR = 0.85
LOWEST_RANK = 30


def to_importance(
    importance: Column | None,
    rank_search: Column,
    factor: float = DEFAULT_FACTOR,
    null_importance: str = "zero",
) -> Column:
    """Weighted mean of the importance and the search rank (0 = most important, 30 = least).

    ``null_importance='zero'`` reads a missing importance as 0; ``'rank_only'`` scores by rank alone.
    """
    # the complement in decimal: 1 - 0.85 in doubles is not 0.15
    rest = float(Decimal(1) - Decimal(str(factor)))
    by_rank = (F.lit(LOWEST_RANK) - F.coalesce(rank_search, F.lit(LOWEST_RANK))) / F.lit(30.0)
    if null_importance == "zero":
        known = F.lit(0.0) if importance is None else F.coalesce(importance, F.lit(0.0))
        return F.lit(factor) * known + F.lit(rest) * by_rank
    if null_importance != "rank_only":
        raise ValueError(f"null_importance: {null_importance}")
    if importance is None:
        return by_rank
    weighted = F.lit(factor) * importance + F.lit(rest) * by_rank
    return F.when(importance.isNotNull(), weighted).otherwise(by_rank)


def browse_score(importance: Column, rank_search: Column, fill: bool = True) -> Column:
    """Score used by listings: the importance, else 0.75 - rank/40, else 0 when ``fill``."""
    by_rank = F.lit(0.75) - rank_search.cast("double") / F.lit(40.0)
    return F.coalesce(importance, F.coalesce(by_rank, F.lit(0.0)) if fill else by_rank)
