"""Scores and classes used in network planning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import settings as S
from .numeric import half_even


def road_weight(label: Column, default: float) -> Column:
    """Weight by longest label prefix; ``default`` when no prefix fits or the label is null."""
    text = F.upper(F.trim(label))
    weight = F.lit(float(default))
    for prefix, value in sorted(S.ROAD_WEIGHTS.items(), key=lambda kv: len(kv[0])):
        weight = F.when(text.startswith(prefix), F.lit(value)).otherwise(weight)
    return weight


def road_segment_label(label: Column) -> Column:
    """``a7`` -> ``A-7``; other text is trimmed and upper-cased; null gives the unknown label."""
    pattern = "^(" + "|".join(S.ROAD_WEIGHTS) + r")(\d.*)"
    return F.coalesce(F.regexp_replace(F.upper(F.trim(label)), pattern, "$1-$2"), F.lit(S.UNKNOWN_ROAD))


def grid_status(capacity_mw: Column) -> Column:
    """Readiness of a substation for one station; unknown capacity counts as zero."""
    kw = F.coalesce(capacity_mw, F.lit(0.0)) * 1000
    return (
        F.when(kw >= S.SUFFICIENT_KW, "Sufficient").when(kw >= S.MODERATE_KW, "Moderate").otherwise("Congested")
    )


def utilisation(available_mw: Column, occupied_mw: Column) -> Column:
    """Occupied share of the capacity; zero where there is none."""
    whole = F.coalesce(available_mw, F.lit(0.0)) + F.coalesce(occupied_mw, F.lit(0.0))
    return F.when(whole > 0, occupied_mw / F.when(whole > 0, whole)).otherwise(F.lit(0.0))


def pressure_score(growth: Column, weight: Column, connectors: Column) -> Column:
    """Growth x weight / connectors, three digits; at least one connector is assumed."""
    chargers = F.greatest(F.coalesce(connectors, F.lit(1)), F.lit(1))
    return half_even(growth * weight / chargers, 3)


def growth_multiplier(projected: Column, base: float | Column = S.BASE_BEV) -> Column:
    """Projected vehicles over the base fleet."""
    return projected / (base if isinstance(base, Column) else F.lit(float(base)))


def charging_demand(bev: Column, other: Column, weight: float | Column = S.HYBRID_CHARGING_WEIGHT) -> Column:
    """Full electric vehicles plus a share of the others, as a whole number."""
    w = weight if isinstance(weight, Column) else F.lit(float(weight))
    return F.round(bev.cast("double") + w * other.cast("double"), 0).cast("long")
