"""Aggregates and small expressions shared by marts, cards, scores and checks."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def exact_sum(column: Column) -> Column:
    """Money sum as decimal, so the result does not depend on the order of the rows.

    Eight places keep amounts that are not whole cents; rounding is left to the caller.
    """
    return F.sum(column.cast("decimal(24,8)"))


def ratio(part: Column, whole: Column) -> Column:
    """Double division; null for an empty whole."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def ratio_or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(ratio(part, whole), F.lit(0.0))


def rounded(number: Column, places: int) -> Column:
    """A double to ``places``, half away from zero after the shift of the point: as ``round`` of SQL engines does it on
    doubles. ``F.round`` goes by the shortest decimal text and takes 0.50345, which lies below the half, up."""
    shift = 10.0 ** places
    return F.round(number * shift) / shift


def number_or_zero(column: Column) -> Column:
    """Lenient number; null for anything that is not one becomes 0."""
    return F.coalesce(column.try_cast("double"), F.lit(0.0))


def flag_or_false(column: Column) -> Column:
    return F.coalesce(column.cast("boolean"), F.lit(False))


def risk_tier(probability: Column) -> Column:
    """HIGH from 0.70, MEDIUM from 0.40, LOW below; both bounds inclusive."""
    return F.when(probability >= 0.70, "HIGH").when(probability >= 0.40, "MEDIUM").otherwise("LOW")


def alert_priority(risk_level: Column) -> Column:
    """HIGH risk is CRITICAL, MEDIUM risk is HIGH."""
    return F.when(risk_level == "HIGH", "CRITICAL").when(risk_level == "MEDIUM", "HIGH")


def early_buffer(delay_hours: Column) -> Column:
    """Hours a shipment arrived ahead of schedule; late ones have none."""
    return F.greatest(-delay_hours, F.lit(0.0))
