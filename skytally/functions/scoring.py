"""Anomaly score, tier and direction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skytally.constants import (
    ALERT_STATUSES,
    NO_BASELINE,
    SEVERITY_ORDER,
    STD_FLOOR,
    TIERS,
    TOP_TIER,
)


def z_score(count: Column, mean: Column, std: Column) -> Column:
    """Distance from the baseline mean in floored standard deviations.

    ``greatest`` skips NULLs, so a missing baseline must show through the mean.
    """
    return (count - mean) / F.greatest(std, F.lit(STD_FLOOR))


def tier(z: Column) -> Column:
    """Status tier. The ninth decimal absorbs summation noise at an exact boundary,
    which then falls to the worse tier."""
    size = F.round(F.abs(z), 9)
    status = F.when(z.isNull(), NO_BASELINE)
    for limit, name in TIERS:
        status = status.when(size < F.lit(limit), name)
    return status.otherwise(TOP_TIER)


def direction(z: Column, status: Column) -> Column:
    """'spike' or 'drop' for warning or worse, else NULL."""
    return F.when(status.isin(ALERT_STATUSES), F.when(z > 0, "spike").when(z < 0, "drop"))


def severity_rank(status: Column) -> Column:
    """0 is worst; unknown statuses come last."""
    rank = F.when(status == SEVERITY_ORDER[0], 0)
    for position, name in enumerate(SEVERITY_ORDER[1:], 1):
        rank = rank.when(status == name, position)
    return rank.otherwise(len(SEVERITY_ORDER))
